"""Near-duplicate texts by ProbMinHash signatures, banding and exact verification.

A text is the set of its five-word shingles. Every shingle starts a Poisson process of its weight; each arrival falls
on a random register, a register keeps the earliest arrival's shingle, and a process ends once it is later than all
registers hold. Two texts agree in a register with the probability Jaccard similarity of their weights. All weights
are 1, however often a shingle comes, so this is the Jaccard similarity of the sets, the measure that candidates are
verified by: ``SIMILARITY`` or more. Texts that agree in all registers of a band are candidates.

Equal texts are one node from the start. In a bucket nobody is paired with everybody: every node meets one leader of
its buckets, then a few leaders of each bucket that still holds several components. What is left apart is few, and
is compared exactly inside tiles of a bucket, which give out only links that join components; members are ordered
by component, and tiles of one component are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaycast.llm.components import components
from assaycast.llm.text import GOLDEN, U, Words, flat, gram_hash, mix, pack, slices, small, text_slices, trimmed, unpack
from assaycast.sources.tables import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 28, 6
#: Leaders of a bucket in the second round, and texts along each side of a tile.
LEADERS, TILE = 4, 256
#: Bytes of text whose signatures or sets are made at once; a text of 5 words takes as many registers as a long one.
SIGN_BYTES = 1_000_000
SHINGLE_BASE = 0xC6A4A7935BD1E995


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes text by text, their counts, and the number per text. A shorter text is one shingle."""
    h = words.hashes()
    g = mix(gram_hash(h, n, SHINGLE_BASE)) if len(h) >= n else np.zeros(0, U)
    keys, counts, sizes = [], [], np.zeros(len(words.count), np.int64)
    for k, size in enumerate(words.count):
        a = words.first[k]
        if size >= n:
            own, times = np.unique(g[a : a + size - n + 1], return_counts=True)
        elif size:
            own = mix(np.array([size], U) * GOLDEN + gram_hash(h[a : a + size], int(size), SHINGLE_BASE)[:1])
            times = np.ones(1, np.int64)
        else:
            continue
        keys.append(own)
        counts.append(times)
        sizes[k] = len(own)
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64), sizes
    return np.concatenate(keys), np.concatenate(counts), sizes


def prob_min_hash(keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, registers: int) -> np.ndarray:
    """Signature of each text that has shingles: (texts, registers) of shingle hashes."""
    texts = len(sizes)
    arrival = np.full(texts * registers, np.inf)
    held = np.zeros(texts * registers, U)
    own = np.repeat(np.arange(texts), sizes)
    key, weight, at, step = keys, weights, np.zeros(len(keys)), 0
    while len(key):
        step += 1
        r = mix(key + np.full(1, step, U) * GOLDEN)
        u = ((r >> U(11)).astype(np.float64) + 0.5) / 2.0**53
        at = at - np.log(u) / weight
        place = own * registers + (mix(r ^ U(0x5851F42D4C957F2D)) % U(registers)).astype(np.int64)
        sooner = np.flatnonzero(at < arrival[place])
        spot = place[sooner]
        np.minimum.at(arrival, spot, at[sooner])
        first = at[sooner] == arrival[spot]
        held[spot[first]] = key[sooner[first]]
        # a process ends when its next arrival cannot be the earliest anywhere
        here = np.unique(own)
        latest = np.zeros(texts)
        latest[here] = arrival.reshape(texts, registers)[here].max(1)
        live = at < latest[own]
        key, weight, at, own = key[live], weight[live], at[live], own[live]
    return held.reshape(texts, registers)


def bands(signature: np.ndarray, n: int, rows: int) -> np.ndarray:
    """One key per text and band."""
    out = np.empty((len(signature), n), U)
    for b in range(n):
        out[:, b] = mix(gram_hash(signature[:, b * rows : (b + 1) * rows].ravel(), rows, SHINGLE_BASE)[::rows] + GOLDEN * np.full(1, b + 1, U))
    return out


def set_weights(counts: np.ndarray) -> np.ndarray:
    """Weight 1 for every shingle of a text."""
    return np.ones(len(counts))


def signatures(docs: DataFrame, n: int = BANDS, rows: int = ROWS, weights: Callable[[np.ndarray], np.ndarray] = set_weights) -> DataFrame:
    """``id, text_hash, node, bands``: node, 16 bytes, stands for the sequence of words; without words both are null. docs: ``id, text_hash, text``.

    ``weights`` gives the weights of shingles from the times that they come in their text.
    """

    def run(batches):
        for b in batches:
            for i, j, data, off in text_slices(b, "text", SIGN_BYTES):
                w = Words(data, off)
                keys, counts, sizes = shingles(w)
                full = np.flatnonzero(sizes)
                key = bands(prob_min_hash(keys, weights(counts), sizes[full], n * rows), n, rows)
                raw = data.tobytes()
                nodes = [xxhash.xxh3_128_digest(b" ".join(raw[a:z].split())) if s else None for a, z, s in zip(off[:-1], off[1:], sizes)]
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, n, 0))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key.ravel().view(np.int64)))
                own = [b.column(c).slice(i, j - i) for c in ("id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(nodes, pa.binary()), lists], ["id", "text_hash", "node", "bands"])

    return docs.mapInArrow(trimmed(run), f"id {dict(docs.dtypes)['id']}, text_hash long, node binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` (sorted 64-bit hashes as bytes) of the wanted ``wanted_id, wanted_hash, node``; one row per node."""
    kind = dict(docs.dtypes)["id"]

    def pack_texts(batches):
        for b in batches:
            for part in small(b):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), pa.array(pack(part.column("text").cast(pa.large_binary()).to_pylist()), pa.binary())], ["id", "text_hash", "packed"])

    def run(batches):
        for b in batches:
            for part0 in small(b):
                texts = pa.array(unpack(part0.column("packed").to_pylist()), pa.large_binary())
                nodes = part0.column("node").to_pylist()
                for i, j, data, off in slices(*flat(texts), SIGN_BYTES):
                    keys, _, sizes = shingles(Words(data, off))
                    ends = np.cumsum(sizes)
                    raw = data.tobytes()
                    rows = [
                        (nodes[i + k], keys[e - s : e].tobytes())
                        for k, (s, e) in enumerate(zip(sizes, ends))
                        if xxhash.xxh3_128_digest(b" ".join(raw[off[k] : off[k + 1]].split())) == nodes[i + k]
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.binary()) for c in (0, 1)], ["node", "shingles"])

    packed = docs.select("id", "text_hash", "text").mapInArrow(trimmed(pack_texts), f"id {kind}, text_hash long, packed binary")
    # the hash as well: texts with null or repeated ids would all meet each other
    same = (packed.text_hash == wanted.wanted_hash) & packed.id.eqNullSafe(wanted.wanted_id)
    met = packed.join(wanted, same).select("node", "packed")
    found = met.mapInArrow(trimmed(run), "node binary, shingles binary")
    # an id that comes twice with one text gives the same set twice
    return cut_lineage(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "near-sets")


def _verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b`` of the pairs whose sets are similar."""

    @F.pandas_udf("double")
    def jaccard(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for s, t in zip(x, y):
            p, q = np.frombuffer(s, U), np.frombuffer(t, U)
            both = len(p) + len(q) - len(np.union1d(p, q))
            out.append(both / (len(p) + len(q) - both))
        return pd.Series(out)

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    rated = pairs.join(left, "a").join(right, "b").select("a", "b", jaccard("x", "y").alias("s"))
    return rated.where(F.col("s") >= similarity).select("a", "b")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, d, node, root`` of the buckets that hold several components."""
    placed = members.join(roots, "node", "left").select("key", "d", "node", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("key")
    return cut_lineage(placed.join(split, "key", "left_semi"), "near-open")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set of distinct hashes."""
    keys = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    column = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    out = np.zeros((len(left), len(right)))
    heads = np.flatnonzero(np.diff(column, prepend=-1))
    for i in range(0, len(heads), 4096):
        a, z = heads[i], heads[i + 4096] if i + 4096 < len(heads) else len(column)
        part = np.zeros((len(left) + len(right), min(4096, len(heads) - i)), np.float32)
        part[owner[a:z], np.cumsum(np.diff(column[a:z], prepend=column[a]) != 0)] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def _tiles(placed: DataFrame, sets: DataFrame, similarity: float, size: int) -> DataFrame:
    """Links ``a, b`` between different components of a bucket, found tile by tile."""
    order = Window.partitionBy("key").orderBy("root", "node")
    blocked = placed.withColumn("block", F.floor((F.row_number().over(order) - 1) / size).cast("int")).select("key", "block", "node", "root")
    blocked = cut_lineage(blocked, "near-blocks")
    block = blocked.groupBy("key", "block").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    x, y = block.alias("x"), block.alias("y")
    apart = "x.block <= y.block and not (x.r1 = x.r2 and x.r1 = y.r1 and x.r1 = y.r2)"
    tiles = x.join(y, "key").where(apart).select("key", F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    ends = F.explode(F.array_distinct(F.array("i", "j")))
    rows = tiles.select("key", "i", "j", ends.alias("block")).join(blocked, ["key", "block"]).join(sets, "node")

    def compare(t: pa.Table) -> pa.Table:
        blocks = t["block"].to_numpy()
        nodes, roots = t["node"].to_pylist(), t["root"].to_pylist()
        hashes = [np.frombuffer(s, U) for s in t["shingles"].to_pylist()]
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        left, right = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        both = overlaps([hashes[k] for k in left], [hashes[k] for k in right])
        n = np.array([len(h) for h in hashes])
        near = both >= similarity * (n[left][:, None] + n[right][None, :] - both) - 1e-9
        seen: dict = {}

        def find(r):
            while seen.get(r, r) != r:
                r = seen[r]
            return r

        links = []
        for p, q in zip(*np.nonzero(near)):
            a, b = left[p], right[q]
            ra, rb = find(roots[a]), find(roots[b])
            if ra != rb:
                seen[ra] = rb
                links.append((nodes[a], nodes[b]))
        return pa.table({"a": pa.array([v[0] for v in links], pa.binary()), "b": pa.array([v[1] for v in links], pa.binary())})

    return rows.groupBy("key", "i", "j").applyInArrow(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, n_bands: int = BANDS,
    rows: int = ROWS, leaders: int = LEADERS, tile: int = TILE, weights: Callable[[np.ndarray], np.ndarray] = set_weights,
) -> DataFrame:
    """``doc_id, text_class, class_id, class_size, text_hash, class_key`` of every row.

    ``class_id`` is the least id of the texts linked, over any number of links, to this one; ``text_class`` the least id
    of the documents with the same words. Null texts and texts without words are classes of their own. The least id is that of
    non-null ids, if there is one; ``text_hash`` is xxhash64 of the text. Rows that repeat are copies of each other and come back as often as they came.
    Where ids are null or repeat, several classes can have one ``class_id``; ``class_key`` tells classes apart: the least
    node of the class, for texts without words a hash of id and text. ``weights`` only affects which texts become
    candidates; other than 1, they find fewer of the pairs whose sets are similar.
    """
    base = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    signed = cut_lineage(signatures(base, n_bands, rows, weights), "near-signatures")
    # one row stands for the words: the least id, null last
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("least")
    texts = signed.where("node is not null").groupBy("node").agg(least, F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    texts = cut_lineage(texts.withColumns({"wanted_id": F.col("least.id"), "wanted_hash": F.col("least.text_hash")}).drop("least"), "near-texts")
    exploded = texts.select("node", F.explode("bands").alias("key"))
    buckets = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(exploded.join(buckets, "key").select("key", "node", "n"), "near-shared")
    # the text that others were made from shares most buckets with them: it leads first (least ``d``)
    degree = shared.groupBy("node").agg((-F.sum("n")).alias("d"))
    members = cut_lineage(shared.join(degree, "node").select("key", "d", "node"), "near-buckets")
    wanted = texts.join(members.select("node").distinct(), "node", "left_semi").select("wanted_id", "wanted_hash", "node")
    sets = _sets(base, wanted)

    # first round: each node and the first leader of its buckets
    first = members.groupBy("key").agg(F.min(F.struct("d", "node")).alias("leader"))
    led = members.join(first, "key").where(F.col("node") != F.col("leader.node")).groupBy("node").agg(F.min("leader").alias("leader"))
    pairs = led.select(F.greatest("node", "leader.node").alias("a"), F.least("node", "leader.node").alias("b")).distinct()
    tried = cut_lineage(pairs, "near-tried")
    links = cut_lineage(_verify(tried, sets, similarity), "near-links")
    roots = components(links)

    # second round: some more leaders of the buckets that still hold several components
    placed = _open(members, roots)
    place = F.row_number().over(Window.partitionBy("key").orderBy("d", "node"))
    lead = placed.withColumn("i", place).where(F.col("i") <= leaders).drop("i")
    met = placed.alias("p").join(lead.alias("l"), "key").where("p.root != l.root")
    pairs = met.select(F.greatest("p.node", "l.node").alias("a"), F.least("p.node", "l.node").alias("b")).distinct()
    pairs = cut_lineage(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
    links = links.unionByName(cut_lineage(_verify(pairs, sets, similarity), "near-links"))
    roots = components(links)

    # the rest: what the leaders left apart is compared inside tiles of the bucket
    links = links.unionByName(cut_lineage(_tiles(_open(members, roots), sets, similarity, tile), "near-links"))
    roots = components(links)

    placed = texts.select("node", "wanted_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = placed.groupBy("root").agg(F.min("wanted_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_text = placed.join(classes, "root")
    out = signed.select("id", "text_hash", "node").join(of_text, "node", "left")
    single = F.col("node").isNull()
    alone = F.unhex(F.sha2(F.to_json(F.struct("id", "text_hash")), 256))
    return out.select(
        F.col("id").alias(doc_id), F.when(single, F.col("id")).otherwise(F.col("wanted_id")).alias("text_class"),
        F.when(single, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(single, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        "text_hash", F.when(single, alone).otherwise(F.col("root")).alias("class_key"),
    )
