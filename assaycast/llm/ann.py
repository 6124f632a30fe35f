"""Nearest neighbours by adaptive dimension scans of inverted lists.

Vectors are scaled to length 1, turned by a random rotation, and dealt to the nearest of some centres. A tile is up to
``BLOCK`` vectors of a list, stored as blocks of ``COLUMNS`` dimensions, and up to ``QUERIES`` queries that probe the
list. A scan adds up squared distances block of dimensions by block; after each block a hypothesis test drops the
candidates whose partial distance, scaled to all dimensions, is too far above the k-th distance so far. What is
left is scored exactly on the original vectors. Centres, rotation and the number of probes come from a
bounded sample; every vector is indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.sources.tables import cut_lineage

SAMPLE, TUNING_QUERIES = 10_000, 300
#: Share of a sampled query's neighbours whose lists are probed.
COVERAGE = 0.98
BLOCK, QUERIES, COLUMNS = 4096, 1024, 16
#: Looseness of the test; the larger, the fewer true neighbours are dropped.
EPSILON = 2.1
MOST_LISTS = 4096


def usable(vector: str) -> Column:
    """No nulls, only finite numbers, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component below 1: products cannot overflow, and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def first_of_ids(ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first row of each id, for the k ids that come first."""
    return np.sort(np.unique(ids, return_index=True)[1])[:k]


@dataclass
class Index:
    dim: int
    centres: np.ndarray
    rotation: np.ndarray
    probes: int

    def order(self, u: np.ndarray) -> np.ndarray:
        """Lists from the nearest centre on."""
        return np.argsort(-(u @ self.centres.T), axis=1, kind="stable")


def fit(sample: np.ndarray, rows: int, k: int, seed: int = 9) -> Index:
    """Centres by spherical k-means; as many probes as cover ``COVERAGE`` of the neighbours inside the sample."""
    rng = np.random.default_rng(seed)
    u = unit(sample)
    n, dim = u.shape
    lists = int(min(max(1, np.ceil(np.sqrt(rows) / 4)), MOST_LISTS, n))
    centres = u[rng.choice(n, lists, replace=False)].copy()
    for _ in range(8):
        own = np.argmax(u @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, u)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    own = np.argmax(u @ centres.T, 1)
    q = rng.choice(n, min(n, TUNING_QUERIES), replace=False)
    near = u[q] @ u.T
    near[np.arange(len(q)), q] = -2
    top = np.argsort(-near, 1)[:, : min(k, n - 1)]
    place = np.argsort(np.argsort(-(u[q] @ centres.T), 1), 1)
    ranks = np.sort(np.take_along_axis(place, own[top], 1).ravel())
    probes = int(ranks[int(np.ceil(COVERAGE * len(ranks))) - 1]) + 1 if len(ranks) else lists
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return Index(dim, centres, rotation, probes)


def scan(q: np.ndarray, q_raw: np.ndarray, q_id: int, ids: np.ndarray, blocks: list[np.ndarray], raw: np.ndarray, lengths: np.ndarray, k: int):
    """The k nearest ids of a tile to one query as (ids, scores); nearest first, ties to the smaller id, each id with its best row."""
    dim = len(q)
    limit, kept, kept_d = np.inf, [], []
    held, held_ids = np.zeros(0), np.zeros(0, np.int64)
    for at in range(0, len(ids), 1024):
        rows = np.arange(at, min(at + 1024, len(ids)))
        rows = rows[ids[rows] != q_id]
        part, done = np.zeros(len(rows)), 0
        for b in blocks:
            diff = b[rows] - q[done : done + b.shape[1]]
            part += (diff * diff).sum(1)
            done += b.shape[1]
            if limit < np.inf:
                slack = 1.0 if done == dim else (1 + EPSILON / np.sqrt(done)) ** 2
                stay = part * (dim / done) <= limit * slack + 1e-12
                rows, part = rows[stay], part[stay]
                if not len(rows):
                    break
        kept.append(rows)
        kept_d.append(part)
        if len(rows):
            # k different ids bound the search, however many rows one id has
            held, held_ids = np.concatenate([held, part]), np.concatenate([held_ids, ids[rows]])
            order = np.argsort(held, kind="stable")
            order = order[first_of_ids(held_ids[order], k)]
            held, held_ids = held[order], held_ids[order]
            if len(held) == k:
                limit = held[-1]
    rows, part = np.concatenate(kept), np.concatenate(kept_d)
    rows = rows[part <= limit + 1e-12]
    # sums along rows, so that equal vectors get equal scores wherever they stand
    score = (raw[rows] * q_raw).sum(1) / (lengths[rows] * np.sqrt((q_raw * q_raw).sum()))
    best = np.lexsort((ids[rows], -score))
    best = best[first_of_ids(ids[rows][best], k)]
    return ids[rows][best], score[best]


def nearest(
    vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, seed: int = 9,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its k nearest of all vectors but its own id, by cosine.

    Both tables have an integer id and an array of numbers. Null ids, and vectors that are null, zero, of another than the
    sample's most frequent size, or that hold null or non-finite numbers take no part. Rows that repeat an id count as
    one candidate with its best score. Ties go to the smaller id. Fewer than k candidates: all of them; lists are
    probed on until k + 1 different ids were in reach. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    names = "query_id long, rank int, vec_id long, score double"
    all_rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))
    asking = queries.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))
    rows = all_rows.count()
    sample = [r["v"] for r in all_rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).select("v").collect()]
    if not sample:
        return spark.createDataFrame([], names)
    sizes = np.array([len(v) for v in sample])
    dim = int(np.bincount(sizes).argmax())
    index = fit(np.array([v for v in sample if len(v) == dim]), rows, k, seed)

    def deal(batches):
        for b in batches:
            x = matrix(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.argmax(unit(x) @ index.centres.T, 1).astype(np.int32))], ["id", "v", "list"])

    # rows that repeat are one, so no block of a list is filled by copies
    dealt = cut_lineage(all_rows.where(F.size("v") == dim).dropDuplicates(["id", "v"]).mapInArrow(deal, "id long, v array<double>, list int"), "ann-lists")
    counts, fresh = np.zeros(len(index.centres), np.int64), np.zeros(len(index.centres), np.int64)
    for r in dealt.groupBy("list").count().collect():  # one row per list
        counts[r["list"]] = r["count"]
    # an id counts for one of its lists, so sums over lists never exceed the number of different ids
    for r in dealt.groupBy("id").agg(F.min("list").alias("list")).groupBy("list").count().collect():  # one row per list
        fresh[r["list"]] = r["count"]

    def probe(batches):
        for b in batches:
            order = index.order(unit(matrix(b.column("v"), dim)))
            reach = np.cumsum(fresh[order], axis=1)
            n = np.maximum(index.probes, (reach < k + 1).sum(1) + 1)
            n = np.minimum(n, order.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([o[:m].tolist() for o, m in zip(order, n)], pa.list_(pa.int32()))], ["id", "v", "lists"])

    probing = asking.where(F.size("v") == dim).mapInArrow(probe, "id long, v array<double>, lists array<int>")
    probing = cut_lineage(probing.select("id", "v", F.explode("lists").alias("list")), "ann-probes")
    asked = np.zeros(len(counts), np.int64)
    for r in probing.groupBy("list").count().collect():
        asked[r["list"]] = r["count"]
    parts = spark.createDataFrame(
        [(i, max(1, int(-(-counts[i] // BLOCK))), max(1, int(-(-asked[i] // QUERIES)))) for i in range(len(counts))], "list int, blocks int, groups int"
    )
    # a tile is (list, block of vectors, group of queries); its sizes are bounded, however full a list is
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    left = dealt.join(F.broadcast(parts), "list").select(
        "list", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "id", "v"
    )
    right = probing.join(F.broadcast(parts), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), (own % F.col("groups")).cast("int").alias("group"), "id", "v"
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_i, out_s = [], [], []
        if left.num_rows and right.num_rows:
            ids, raw = left["id"].to_numpy(), scaled(matrix(left["v"], dim))
            turned = unit(raw) @ index.rotation
            blocks = [np.ascontiguousarray(turned[:, a : a + COLUMNS]) for a in range(0, dim, COLUMNS)]
            lengths = np.sqrt((raw * raw).sum(1))
            q_raw = scaled(matrix(right["v"], dim))
            q_turned = unit(q_raw) @ index.rotation
            for q_id, q, x in zip(right["id"].to_pylist(), q_turned, q_raw):
                i, s = scan(q, x, q_id, ids, blocks, raw, lengths, k)
                out_q.append(np.full(len(i), q_id))
                out_i.append(i)
                out_s.append(s)
        cat = lambda p, t: pa.array(np.concatenate(p) if p else np.zeros(0), t)
        return pa.table({"query_id": cat(out_q, pa.int64()), "vec_id": cat(out_i, pa.int64()), "score": cat(out_s, pa.float64())})

    tile = ["list", "block", "group"]
    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
