"""Quality rules judged by an isolation forest.

Per text the rules' statistics are counted; a forest of random splits, grown on a bounded sample of trusted rows,
gives each row the mean depth at which it stands alone. Rows that few splits isolate are anomalous; the
threshold on the score comes from all labelled rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.llm.text import GOLDEN, U, Words, gram_hash, mix, per_text, text_slices
from assaycast.sources.tables import cut_lineage

# ---- fixed values -----------------------------------------------------------------------
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
# -----------------------------------------------------------------------------------------
GRAM_BASE = 0xC2B2AE3D27D4EB4F
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "distinct", "marks", "line_words"]
TREES, SAMPLE = 100, 256
BINS = 1000
#: Share of good labelled rows that the forest may lose.
LOSS = 0.002
_IS = np.zeros((4, 256), bool)
_IS[0, list(SYMBOLS)] = True
_IS[1, 65:91] = True
_IS[2, 48:58] = True
_IS[3, list(b"!?.,;:\"'()[]{}/\\+=_~^@`-")] = True

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + ", ".join(f"f_{f} double" for f in FEATURES)
)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and for each sorted key the size of its run."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(k)))
    return order, np.repeat(size, size)


def slice_stats(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Statistics of the texts of one slice."""
    w = Words(data, off)
    docs = len(off) - 1
    h, own = w.hashes(), w.owner()
    salt = mix(np.arange(docs, dtype=U) * GOLDEN + U(1))
    chars = per_text(w.inner & ((data & 0xC0) != 0x80), off)
    counts = {n: per_text(_IS[i][data], off) for i, n in enumerate(["symbols", "upper", "digits", "marks"])}

    # lines with a word: distinct ones per text
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    feed = data == 10
    begin = np.flatnonzero(edge[:-1] | np.concatenate([[False], feed[:-1]])) if len(data) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(data))[: len(begin)]
    stop = end - feed[end - 1]
    words_to = np.searchsorted(w.start, np.append(begin, len(data)))
    full = np.diff(words_to) > 0
    begin, stop = begin[full], stop[full]
    line_doc = np.searchsorted(off, begin, side="right") - 1
    line = mix(w.bytes.hash(begin, stop) ^ salt[line_doc])
    lines = np.bincount(line_doc, minlength=docs)
    different = np.bincount(line_doc[np.unique(line, return_index=True)[1]], minlength=docs)

    # words in three-word windows that come twice
    gram = gram_hash(h, 3, GRAM_BASE)
    at = np.flatnonzero(w.left() >= 3)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(at):
        order, size = _groups(mix(gram[at] ^ salt[own[at]]))
        twice = at[order[size > 1]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 3, -1)
    repeat = np.bincount(own[np.cumsum(covered[:-1]) > 0], minlength=docs)
    distinct = np.bincount(own[np.unique(mix(h ^ salt[own]), return_index=True)[1]], minlength=docs)

    n = w.count
    some, somechars, somelines = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    features = [
        np.log1p(chars / some), np.sqrt(counts["symbols"] / somechars), np.sqrt((lines - different) / somelines), repeat / some,
        np.sqrt(counts["upper"] / somechars), np.sqrt(counts["digits"] / somechars),
        # distinct words fall with length by themselves: compare with a power of the length
        np.log1p(distinct) / np.log1p(some), np.sqrt(counts["marks"] / somechars), np.log1p(n / somelines),
    ]
    base = [n, chars, counts["symbols"], lines - different, repeat]
    out = dict(zip(["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], [b.astype(np.int64) for b in base]))
    return out | {f"f_{k}": v.astype(np.float64) for k, v in zip(FEATURES, features)}


def rule_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts and features of every row; null text counts as empty."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        for b in batches:
            for i, j, data, off in text_slices(b, "text"):
                out = slice_stats(data, off)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), *map(pa.array, out.values())], ["doc_id", *out])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, {STATS}")


# ---- forest -----------------------------------------------------------------------------
NODES = "tree int, node int, feature int, cut double, low int, high int, depth double"


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(tree: int, x: np.ndarray, limit: int, low: np.ndarray, high: np.ndarray) -> list[tuple]:
    """One tree of random splits of the box from ``low`` to ``high``; a leaf holds its depth plus the expected rest.

    Splits fall anywhere in a node's box, also where no sampled row lies, so a row far from all of them soon
    stands alone even in a feature that is constant among trusted rows.
    """
    rng, nodes, todo = np.random.default_rng(tree + 1), [], [(0, np.arange(len(x)), 0, low, high)]
    count = 1
    while todo:
        node, rows, depth, low, high = todo.pop()
        wide = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(wide):
            nodes.append((tree, node, -1, 0.0, node, node, depth + _average_path(len(rows))))
            continue
        f = int(rng.choice(wide))
        cut = float(rng.uniform(low[f], high[f]))
        nodes.append((tree, node, f, cut, count, count + 1, 0.0))
        left = x[rows, f] <= cut
        to, since = high.copy(), low.copy()
        to[f] = since[f] = cut
        todo += [(count, rows[left], depth + 1, low, to), (count + 1, rows[~left], depth + 1, since, high)]
        count += 2
    return nodes


class Forest:
    def __init__(self, nodes: pd.DataFrame, sample: int):
        self.scale = _average_path(sample) or 1.0
        nodes = nodes.sort_values(["tree", "node"])
        roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
        base = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
        self.roots, self.feature, self.cut = roots, nodes["feature"].to_numpy(), nodes["cut"].to_numpy()
        self.low, self.high = nodes["low"].to_numpy() + base, nodes["high"].to_numpy() + base
        self.depth = nodes["depth"].to_numpy()

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]: 2 to the power of minus mean depth over expected depth."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner & (x[rows, np.maximum(f, 0)] > self.cut[at]), self.high[at], self.low[at])
            total += self.depth[at]
        return 2.0 ** (-total / max(len(self.roots), 1) / self.scale)


def fit_forest(stats: DataFrame, trusted: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest | None:
    """A forest grown on at most ``trees * sample`` trusted rows, the ones with the smallest hash of their id.

    Each tree is grown in its own task from its share of the sample; the box spans all rows of enough words.
    """
    cols = [f"f_{f}" for f in FEATURES]
    enough = stats.where(f"n_words >= {MIN_WORDS}")
    box = enough.agg(*[F.min(c).alias(f"l{c}") for c in cols], *[F.max(c).alias(f"h{c}") for c in cols]).first()
    if box[0] is None:
        return None
    low, high = np.array(box[: len(cols)], float), np.array(box[len(cols) :], float)
    limit = 2 * int(np.ceil(np.log2(max(sample, 2))))
    picked = (
        enough.join(trusted.select("doc_id").distinct(), "doc_id")
        .withColumn("_h", F.xxhash64("doc_id", F.lit(seed))).orderBy("_h", *cols).limit(trees * sample)
        .select((F.pmod(F.shiftright("_h", 7), F.lit(trees))).cast("int").alias("tree"), *cols)
    )

    def one(key, pdf):
        x = pdf.sort_values(cols)[cols].to_numpy(np.float64)
        x = x[np.random.default_rng(key[0] + 100).permutation(len(x))[:sample]]
        return pd.DataFrame(grow(int(key[0]), x, limit, low, high), columns=[c.split()[0] for c in NODES.split(", ")])

    nodes = picked.groupBy("tree").applyInPandas(one, NODES).toPandas()
    return Forest(nodes, sample) if len(nodes) else None


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", loss: float = LOSS,
    trees: int = TREES, sample: int = SAMPLE,
) -> DataFrame:
    """The rule statistics of every row with ``base_failed``, ``score`` and ``kept``.

    labels: ``doc_id, quality``. The threshold is the least score above which at most the share ``loss`` of the good
    labelled rows (quality 1, base rules passed) lies, read from a histogram of all of them. Without good labels there
    is no forest, and the base rules decide alone; the score is then null. Null and empty texts have no
    words and fail the base rules. Rows that repeat are judged alike; a null id is judged like any other.
    """
    rename = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stats = cut_lineage(rule_statistics(rename), "rule-stats")
    good = labels.where("quality = 1").select("doc_id").distinct()
    forest = fit_forest(stats, good, trees, sample)
    cols = [f"f_{f}" for f in FEATURES]

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy() for c in cols])
            score = pa.array(forest.score(x)) if forest else pa.nulls(len(b), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, score], [*b.schema.names, "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields) + ", score double"
    scored = stats.mapInArrow(run, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = cut_lineage(scored.withColumn("base_failed", failed).drop(*cols), "rule-scores")
    bins = (
        scored.where("not base_failed").join(good, "doc_id").groupBy(F.ceil(F.col("score") * BINS).cast("int").alias("bin")).count()
    ).where("bin is not null").collect()  # at most BINS rows
    above, threshold, total = 0, 1.0, sum(r["count"] for r in bins)
    for r in sorted(bins, key=lambda r: -r["bin"]):
        above += r["count"]
        if above > loss * total:
            threshold = r["bin"] / BINS
            break
    anomalous = F.coalesce(F.col("score") > threshold, F.lit(False))
    return scored.withColumn("kept", ~F.col("base_failed") & ~anomalous)
