"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The units are bytes: a gram is the last ``ORDER`` bytes as one number, exact and without hashing, and text starts
after zero bytes. Counts come from four fifths of the trusted documents, by a hash of the id; the fifth held out
(``HELD_OUT``) is never counted and only sets the thresholds, so a language with few trusted texts can lose most of
them to that side. Everything of the size of the model stays in tables sharded by gram: each chunk of documents (a split of the input or a part of one) asks for its distinct grams, the probabilities are joined
to these from order 1 up, and the answers meet the chunk's documents again for scoring: a task holds the answers of one chunk and passes its documents by, batch after batch.

Each language's threshold is a quantile of the scores of all its texts, at the level that its labelled texts set: the share of
good ones among them, but not above the score that best parts its bad labelled texts from the good ones held out (see ``caps``): the
share among a few labelled texts can be far from that of all. Trusted text covers only part of what is good, so its own scores alone would reject good text of another
vocabulary on a small difference; the quantile of trusted texts that took no part in the training is the least threshold.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaycast.llm.text import flat, pack, slices, small, trimmed, unpack
from assaycast.sources.tables import cut_lineage

ORDER = 5
QUANTILE = 0.995
#: One of so many trusted documents is held out for the thresholds.
HELD_OUT = 5
#: Score bins per bit.
BINS = 500
#: Bits of the filter that keeps most untrusted texts out of a shuffle (2 MB).
FILTER_BITS = 24
#: Standard errors by which a short text's mean is lowered.
SLACK = 3.0
#: Bytes of text whose grams are made at once; they take about 60 bytes for each.
SLICE = 500_000
#: Bytes of text of a chunk, about; a larger split is cut by a hash of id and text.
CHUNK_BYTES = 32 << 20
#: Grams counted before they are first merged.
HELD_GRAMS = 500_000


def grams(data: np.ndarray, off: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The gram that ends at each byte of each text."""
    size = np.diff(off)
    place = np.arange(len(data)) - np.repeat(off[:-1], size)
    x = data.astype(np.int64)
    out = x.copy()
    for j in range(1, order):
        back = np.zeros(len(x), np.int64)
        back[j:] = x[: len(x) - j]
        back[place < j] = 0
        out |= back << (8 * j)
    return out


class _Counts:
    """Sums by gram, compacted as they come."""

    def __init__(self):
        self.keys, self.sums = [], []
        self.held, self.limit = 0, HELD_GRAMS

    def add(self, g: np.ndarray) -> None:
        k, c = np.unique(g, return_counts=True)
        self.keys.append(k)
        self.sums.append(c)
        self.held += len(k)
        if self.held > self.limit:
            self.keys, self.sums = ([v] for v in self.total())
            self.held = len(self.keys[0])
            self.limit = 2 * self.held + HELD_GRAMS

    def total(self):
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        return k, np.bincount(at, weights=np.concatenate(self.sums), minlength=len(k)).astype(np.int64)


def _texts(column: pa.Array):
    yield from slices(*flat(column), SLICE)


def requests(docs: DataFrame, order: int) -> DataFrame:
    """``gram, chunks``: every distinct gram and the chunks that hold it; docs: ``chunk, text``."""

    def run(batches):
        sums: dict[int, _Counts] = {}
        for b in batches:
            chunks = b.column("chunk").to_numpy()
            if (np.diff(chunks) != 0).any():
                by = np.argsort(chunks, kind="stable")
                b, chunks = b.take(pa.array(by)), chunks[by]
            for a, z in _segments(chunks):
                own = sums.setdefault(int(chunks[a]), _Counts())
                for _, _, data, off in _texts(b.column("text").slice(a, z - a)):
                    own.add(grams(data, off, order))
        for chunk, own in sums.items():
            k, _ = own.total()
            for i in range(0, len(k), 100_000):
                part = k[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), chunk))], ["gram", "chunk"])

    asked = docs.mapInArrow(trimmed(run), "gram long, chunk long")
    return cut_lineage(asked.groupBy("gram").agg(F.collect_set("chunk").alias("chunks")), "kn-requests")


def _segments(keys: np.ndarray):
    cut = np.flatnonzero(np.diff(keys)) + 1
    return zip(np.concatenate([[0], cut]), np.append(cut, len(keys))) if len(keys) else ()


def trusted_counts(docs: DataFrame, trusted: DataFrame, order: int) -> DataFrame:
    """``h, c``: counts of the grams of all trusted training texts.

    A bitmap of fixed size keeps most other texts from the shuffle; the join after it is exact.
    """
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    words = trusted.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("bits"))
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.toLocalIterator():  # at most 2**FILTER_BITS / 64 rows
        bitmap[r["w"]] = r["bits"]

    def sift(batches):
        for b in batches:
            s = b.column("slot").to_numpy()
            keep = (bitmap[s >> 6] >> (s & 63)) & 1 > 0
            for part in small(b.filter(pa.array(keep))):
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pack(texts), pa.binary())], ["doc_id", "packed"])

    kind = dict(docs.dtypes)["doc_id"]
    likely = docs.select("doc_id", slot.alias("slot"), "text").mapInArrow(trimmed(sift), f"doc_id {kind}, packed binary")

    def count(batches):
        own = _Counts()
        for b in batches:
            for part in small(b):
                for _, _, data, off in _texts(pa.array(unpack(part.column("packed").to_pylist()), pa.large_binary())):
                    own.add(grams(data, off, order))
        k, c = own.total()
        for i in range(0, len(k), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000]), pa.array(c[i : i + 100_000])], ["h", "c"])

    counted = likely.join(trusted, "doc_id").select("packed").mapInArrow(trimmed(count), "h long, c long")
    return cut_lineage(counted.groupBy("h").agg(F.sum("c").alias("c")), "kn-counts")


def _tail(c: str, n: int) -> Column:
    return F.col(c).bitwiseAND(F.lit((1 << (8 * n)) - 1))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, above 0 and at most the count.

    Low orders of a large corpus have few rare grams, so an estimate can come out at 0 or below. Nothing would be left
    for what a context has not been seen with, whose probability would be 0; such an estimate gives way to a fixed one.
    """
    fixed = (0.5, 1.0, 1.5)
    if not n1 or not n2:
        return fixed
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(v, float(i + 1)) if v > 0 else fixed[i] for i, v in enumerate(d))


def probabilities(seen: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """``gram, bits`` (minus log2 of its probability) of every wanted gram; seen: ``h, c`` of the highest order.

    Lower orders count the distinct bytes before a gram. From order 1 up every wanted gram takes its discounted
    count, its context's sum and back-off mass, and the probability of its tail, each by a join on the key.
    """
    levels = {order: seen}
    for k in range(order - 1, 0, -1):
        levels[k] = cut_lineage(levels[k + 1].groupBy(_tail("h", k).alias("h")).agg(F.count(F.lit(1)).alias("c")), "kn-level")
    of_counts = None
    for k, level in levels.items():
        row = level.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).withColumn("k", F.lit(k))
        of_counts = row if of_counts is None else of_counts.unionByName(row)
    d = {r["k"]: discounts(r["n1"], r["n2"], r["n3"], r["n4"]) for r in of_counts.collect()}  # one row per order
    lower = None
    for k in range(1, order + 1):
        level = levels[k]
        cut = F.when(F.col("c") == 1, d[k][0]).when(F.col("c") == 2, d[k][1]).otherwise(d[k][2])
        contexts = level.groupBy(F.shiftright("h", 8).alias("ctx")).agg(F.sum("c").alias("total"), F.sum(cut).alias("mass"))
        asked = wanted.select(_tail("gram", k).alias("h")).distinct() if k < order else wanted.select(F.col("gram").alias("h"))
        own = asked.join(level, "h", "left").withColumn("ctx", F.shiftright("h", 8)).join(contexts, "ctx", "left")
        if lower is None:
            own = own.withColumn("p0", F.lit(1 / 256))
        else:
            own = own.withColumn("tail", _tail("h", k - 1)).join(lower.select(F.col("h").alias("tail"), F.col("p").alias("p0")), "tail")
        p = F.when(
            F.col("total") > 0,
            F.coalesce(F.greatest(F.col("c") - cut, F.lit(0.0)), F.lit(0.0)) / F.col("total") + F.col("mass") / F.col("total") * F.col("p0"),
        ).otherwise(F.col("p0"))
        lower = cut_lineage(own.select("h", p.alias("p")), "kn-p")
    return lower.select(F.col("h").alias("gram"), (-F.log2("p")).alias("bits"))


def look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of every asked gram; keys: sorted. A gram that is not there, or has no finite value, is an error, not a neighbour's value or a NaN that sums carry on."""
    at = np.searchsorted(keys, asked)
    if len(asked) and (not len(keys) or at.max() >= len(keys) or not np.array_equal(keys[at], asked)):
        raise RuntimeError("a chunk holds grams that it did not ask for: the input was split in two ways")
    got = values[at]
    if not np.isfinite(got).all():
        raise RuntimeError("a gram has no probability above 0")
    return got


def scores(docs: DataFrame, bits: DataFrame, asked: DataFrame, order: int) -> DataFrame:
    """``doc_id, text_hash, lang, n_bytes, mean_bits, score`` of every row; docs: ``chunk, doc_id, text_hash, lang, text``.

    Rows of answers and of texts are dealt by chunk and sorted, a chunk's answers before its texts, so that neither side of a chunk is one Arrow batch.
    """
    kind, own = dict(docs.dtypes)["doc_id"], ["chunk", "doc_id", "text_hash", "lang"]

    def pack_texts(batches):
        for b in batches:
            for part in small(b):
                packed = pa.array(pack(part.column("text").cast(pa.large_binary()).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), packed], [*own, "packed"])

    packed = docs.select(*own, "text").mapInArrow(trimmed(pack_texts), f"chunk long, doc_id {kind}, text_hash long, lang string, packed binary")
    # ``key`` is the gram of an answer and the hash of a text; only answers have ``bits``
    texts = packed.select("chunk", F.col("text_hash").alias("key"), F.lit(None).cast("float").alias("bits"), "doc_id", "lang", "packed")
    answers = asked.join(bits, "gram").select(
        F.explode("chunks").alias("chunk"), F.col("gram").alias("key"), F.coalesce("bits", F.lit(float("nan"))).cast("float").alias("bits"),
        F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("binary").alias("packed"),
    )
    names = ["doc_id", "text_hash", "lang", "n_bytes", "mean_bits", "score"]

    def rate(rows: pa.RecordBatch, keys: np.ndarray, values: np.ndarray):
        for part in small(rows, 256):
            for i, j, data, off in _texts(pa.array(unpack(part.column("packed").to_pylist()), pa.large_binary())):
                v = look_up(keys, values, grams(data, off, order))
                n = np.diff(off)
                some = np.maximum(n, 1)
                s = np.concatenate([[0.0], np.cumsum(v)])
                q = np.concatenate([[0.0], np.cumsum(v * v)])
                mean = (s[off[1:]] - s[off[:-1]]) / some
                spread = np.sqrt(np.maximum((q[off[1:]] - q[off[:-1]]) / some - mean**2, 0))
                empty = n == 0
                cols = [part.column(c).slice(i, j - i) for c in ("doc_id", "key", "lang")]
                cols += [pa.array(n), pa.array(mean, mask=empty), pa.array(mean - SLACK * spread / np.sqrt(some), mask=empty)]
                yield pa.RecordBatch.from_arrays(cols, names)

    def run(batches):
        chunk, found, index = None, [], None
        for b in batches:
            chunks = b.column("chunk").to_numpy()
            for a, z in _segments(chunks):
                part = b.slice(a, z - a)
                if chunk != chunks[a]:
                    chunk, found, index = chunks[a], [], None
                n = part.num_rows - part.column("bits").null_count
                if n:
                    found.append((part.column("key").slice(0, n).to_numpy().copy(), part.column("bits").slice(0, n).to_numpy().astype(np.float64)))
                if n < part.num_rows:
                    if index is None:
                        keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in found)])
                        by = np.argsort(keys)
                        index, found = (keys[by], np.concatenate([np.zeros(0), *(v for _, v in found)])[by]), []
                    yield from rate(part.slice(n), *index)

    met = texts.unionByName(answers).repartition("chunk").sortWithinPartitions("chunk", F.col("bits").isNull())
    return met.mapInArrow(trimmed(run), f"doc_id {kind}, text_hash long, lang string, n_bytes long, mean_bits double, score double")


def _each_and_all(rows: DataFrame) -> DataFrame:
    """``rows`` by language, and once more under the language '' for everyone. A null language is the text ''."""
    own = rows.withColumn("lang", F.coalesce("lang", F.lit("")))
    return own.withColumn("all", F.lit(False)).unionByName(own.withColumn("lang", F.lit("")).withColumn("all", F.lit(True)))


def thresholds(rated: DataFrame, level: float | DataFrame) -> DataFrame:
    """``all, lang, threshold``: the upper edge of the bin that reaches the level; one row with ``all`` is everyone's.

    rated: ``lang, score``; level: one for every language, or ``level_all, level_lang, level``. A histogram is merged; no scores are sorted.
    """
    bins = rated.where("score is not null").select("lang", F.ceil(F.col("score") * BINS).alias("bin"))
    hist = _each_and_all(bins).groupBy("all", "lang", "bin").count()
    w = Window.partitionBy("all", "lang")
    part = hist.withColumn("part", F.sum("count").over(w.orderBy("bin")) / F.sum("count").over(w))
    if isinstance(level, float):
        part = part.withColumn("level", F.lit(level))
    else:
        part = part.join(level, (F.col("all") == F.col("level_all")) & (F.col("lang") == F.col("level_lang")))
    return part.where("part >= level").groupBy("all", "lang").agg((F.min("bin") / BINS).alias("threshold"))


def levels(scored: DataFrame, quality: DataFrame) -> DataFrame:
    """``level_all, level_lang, level``: the share of good texts among a language's labelled ones.

    quality: ``doc_id, q``. Languages without a labelled text take everyone's share; without any good text there is no row.
    """
    marked = scored.where("score is not null").join(quality.where("q is not null"), "doc_id").select("lang", "q")
    shares = _each_and_all(marked).groupBy("all", "lang").agg(F.avg((F.col("q") == 1).cast("double")).alias("own"))
    shares = cut_lineage(shares, "kn-levels")
    everyone = shares.where("all and own > 0").select("own").scalar()
    every = _each_and_all(scored.select("lang").distinct()).distinct().select(F.col("all").alias("level_all"), F.col("lang").alias("level_lang"))
    met = every.join(shares, (F.col("all") == F.col("level_all")) & (F.col("lang") == F.col("level_lang")), "left")
    return met.select("level_all", "level_lang", F.when(everyone.isNotNull(), F.coalesce("own", everyone)).alias("level")).where("level is not null")


def caps(scored: DataFrame, quality: DataFrame, held: DataFrame) -> DataFrame:
    """``lang, cap``: the largest threshold at which the labelled texts outside the training are mistaken least.

    quality: ``doc_id, q``; held: ids of the held-out trusted documents, each of which stands for ``HELD_OUT`` good ones. A bad text at or
    below the threshold and a good one above it are mistakes. Only languages with texts of both kinds have a row; above all these texts there is no cap (null).
    """
    rated = scored.where("score is not null").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.ceil(F.col("score") * BINS).alias("bin"))
    none = F.lit(0).cast("long")
    good = rated.join(held, "doc_id", "left_semi").select("lang", "bin", F.lit(HELD_OUT).cast("long").alias("good"), none.alias("bad"))
    bad = rated.join(quality.where("q = 0"), "doc_id", "left_semi").select("lang", "bin", none.alias("good"), F.lit(1).cast("long").alias("bad"))
    hist = good.unionByName(bad).groupBy("lang", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    w = Window.partitionBy("lang")
    upto = w.orderBy("bin")
    wrong = F.sum("bad").over(upto) + F.sum("good").over(w) - F.sum("good").over(upto)
    both = (F.sum("good").over(w) > 0) & (F.sum("bad").over(w) > 0)
    # a threshold in a bin holds up to the bin before the next one that is not empty
    rows = hist.select("lang", "bin", wrong.alias("wrong"), (F.lead("bin").over(upto) - 1).alias("upper"), both.alias("both")).where("both")
    best = rows.groupBy("lang").agg(F.min(F.struct("wrong", (-F.col("bin")).alias("bin"), "upper")).alias("best"))
    return best.select("lang", (F.col("best.upper") / BINS).alias("cap"))


def chunk_of_input(docs: DataFrame, doc_id: str, text: str) -> Column:
    """A number for the input split of a row, or for a part of a split of more than ``CHUNK_BYTES`` of text; rows that come from no file are dealt by the hash of their id.

    A split can hold far more text than its length says (repeated texts stored once, a row group of several splits), so the texts are measured first.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = [F.input_file_name().alias("file"), F.input_file_block_start().alias("start")]
    sizes = docs.select(*split, F.input_file_block_length().alias("length"), F.octet_length(text).alias("bytes")).where("file != ''")
    sizes = sizes.groupBy("file", "start").agg(F.max("length").alias("length"), F.sum("bytes").alias("bytes"))
    size = sizes.agg(F.sum("length").alias("length"), F.sum("bytes").alias("bytes")).first()
    rate = (size["bytes"] or 0) / max(size["length"] or 0, 1)
    parts = F.greatest(F.ceil(F.input_file_block_length() * rate / CHUNK_BYTES), F.lit(1))
    part = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), parts)
    split = F.xxhash64(F.input_file_name(), F.input_file_block_start(), part)
    return F.when(F.input_file_name() != "", split).otherwise(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(n)))


@contextlib.contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Inside, every scan cuts an input into the same splits. Else the cores known at the time of a scan take part, which change as executors join or are lost."""
    key = "spark.sql.files.minPartitionNum"
    free = spark.conf.get(key, None) is None
    if free:
        spark.conf.set(key, spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if free:
            spark.conf.unset(key)


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
    quantile: float = QUANTILE,
) -> DataFrame:
    """``doc_id, lang, n_bytes, perplexity, score, threshold, kept, text_hash`` (xxhash64) of every row.

    labels: ``doc_id, quality``; trusted are documents with a label 1 and none of 0. ``perplexity`` is per byte,
    ``score`` its log2 less ``SLACK`` standard errors, so that a short text is not rejected on little evidence, and
    a text is kept if the score is at most its language's threshold: the quantile of all its texts at the share of good ones among
    its labelled texts (see ``levels``) or the cap of its bad labelled texts (see ``caps``) if that is lower, and at least the ``quantile`` of its held-out trusted texts. A language without labelled or
    held-out texts takes the share or the quantile of all of them together; without any trusted text everything is kept. Null and empty
    texts have no bytes and no perplexity, and are not kept. Null ids, null languages (a language of their own) and rows
    that repeat are judged like others.
    """
    if not 2 <= order <= 7:
        raise ValueError("an order from 2 to 7 fits a number")
    quality = labels.groupBy("doc_id").agg(F.min("quality").alias("q"))
    trusted = quality.where("q = 1").select("doc_id")
    held = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(HELD_OUT)) == 0
    with same_splits(docs.sparkSession):
        rows = docs.select(
            chunk_of_input(docs, doc_id, text).alias("chunk"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
        )
        asked = requests(rows.select("chunk", "text"), order)
        seen = trusted_counts(rows.select("doc_id", "text"), trusted.where(~held), order)
        bits = probabilities(seen, asked.select("gram"), order)
        scored = cut_lineage(scores(rows, bits, asked, order), "kn-scores")
    limits = cut_lineage(thresholds(scored.join(trusted.where(held), "doc_id", "left_semi"), quantile), "kn-limits")
    everyone = limits.where("all").select("threshold").scalar()
    own = limits.where("not all").select(F.col("lang").alias("_lang"), "threshold")
    share = thresholds(scored, levels(scored, quality)).where("not all").select(F.col("lang").alias("_share_lang"), F.col("threshold").alias("_share"))
    cap = caps(scored, quality, trusted.where(held)).select(F.col("lang").alias("_cap_lang"), F.col("cap").alias("_cap"))
    # least() passes over the null of a language without a cap
    share = share.join(cap, F.col("_share_lang") == F.col("_cap_lang"), "left").select("_share_lang", F.least("_share", "_cap").alias("_share"))
    share = cut_lineage(share, "kn-shares")
    out = scored.join(own, F.coalesce("lang", F.lit("")) == F.col("_lang"), "left").join(share, F.coalesce("lang", F.lit("")) == F.col("_share_lang"), "left")
    limit = F.coalesce(F.greatest(F.coalesce("threshold", everyone), "_share"), F.lit(float("inf")))
    return out.select(
        "doc_id", "lang", "n_bytes", F.pow(F.lit(2.0), "mean_bits").alias("perplexity"), "score", limit.alias("threshold"),
        F.coalesce(F.col("score") <= limit, F.lit(False)).alias("kept"), "text_hash",
    )
