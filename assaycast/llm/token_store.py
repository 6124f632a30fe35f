"""Token ids as bit-plane or byte-plane shuffled binary chunks.

Texts are encoded with a ``tokenizers`` file, every document ends with ``end_id``, and the ids follow each other in
ascending document order. A chunk holds ``block`` ids (the last of a shard fewer): the ids as little-endian 32-bit
numbers are transposed into 4 byte planes or 32 bit planes, and each plane is compressed with zstandard. One row of
the stored table is one chunk: its planes, its place (shard, chunk, first id, ids) and the documents that begin
in it; these columns without the planes are the chunk index. Spark's committer writes the rows, so a task
that is lost and run again leaves no second copy.
"""

from __future__ import annotations

import collections
import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaycast.llm.text import small

BLOCK = 65_536
#: Unit of the end id.
END = 0
#: Distinct units after which an encoder forgets the rare ones.
CACHE_UNITS = 700_000
#: Units that are encoded in a row; longer rows take more time a unit.
ROW_UNITS = 500
#: First units of texts that are kept, and how long one may be.
HEADS = 50_000
HEAD_CHARS = 100
CHUNKS = (
    "shard int, chunk int, first_id long, n_ids int, layout string, "
    "docs array<struct<doc_id:long,start:long,n_tokens:long>>, planes array<binary>"
)


# ---- planes -----------------------------------------------------------------------------
def to_planes(ids: np.ndarray, layout: str = "byte", level: int = 3) -> list[bytes]:
    ids = ids.astype(np.uint32, copy=False)
    planes = [(ids >> np.uint32(8 * k)).astype(np.uint8) for k in range(4)]
    if layout == "bit":
        planes = [np.packbits((p >> k) & 1, bitorder="little") for p in planes for k in range(8)]
    z = zstandard.ZstdCompressor(level=level)
    return [z.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, layout: str = "byte") -> np.ndarray:
    z = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(z.decompress(p), np.uint8) for p in planes]
    if layout == "bit":
        parts = [np.unpackbits(p, bitorder="little", count=n) for p in parts]
    width, out = 8 * 4 // len(parts), np.zeros(n, "<u4")
    for k, p in enumerate(parts):
        if p.any():
            out |= p.astype("<u4") << np.uint32(k * width)
    return out


# ---- encoding ---------------------------------------------------------------------------
class Encoder:
    """Ids of texts; repeated units are encoded once.

    The tokenizer's pattern never joins a space or line feed to what stands before it, so a text falls apart in front of
    its single spaces and line feeds into units that encode alone as they do in place. Texts with two white-space
    characters in a row or one at the end, and all texts of a tokenizer with another pattern, are encoded whole.
    """

    UNSAFE = re.compile(r"\s(?:\s|\Z)")
    #: All white space but the space and the line feed; a text with any of it is searched for ``UNSAFE``.
    RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.splits = "'use_regex': True" in str(self.tokenizer.pre_tokenizer) or "use_regex=True" in str(self.tokenizer.pre_tokenizer)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = np.array([self._bytes(i) for i in range(size)], np.int64)
        self.reset()

    def _bytes(self, i: int) -> int:
        token = self.tokenizer.id_to_token(i)
        added = self.tokenizer.get_added_tokens_decoder()
        return len(token.encode()) if token is None or i in added else len(token)

    def whole(self, text: str) -> np.ndarray:
        # the batch call can leave out the offsets of the tokens
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def falls_apart(self, text: str) -> bool:
        """Whether no two white-space characters follow each other and none is the last; plain searches are several times as fast as the pattern."""
        if any(map(text.__contains__, self.RARE)):
            return not self.UNSAFE.search(text)
        return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text.endswith((" ", "\n")))

    def head(self, text: str) -> np.ndarray:
        """Ids of the first unit of a text, kept if it is short, or of a text that is encoded whole."""
        if len(text) > HEAD_CHARS:
            return self.whole(text)
        ids = self.heads.get(text)
        if ids is None:
            if len(self.heads) >= HEADS:
                self.heads.clear()
            ids = self.heads[text] = self.whole(text)
        return ids

    def units(self, missing: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that begin with a space or line feed, and how many each has, from encodings of ``ROW_UNITS`` of them in a row."""
        ids = np.concatenate([self.whole("".join(missing[i : i + ROW_UNITS])) for i in range(0, len(missing), ROW_UNITS)])
        at = np.cumsum(self.width[ids])
        ends = np.cumsum(pc.binary_length(pa.array(missing, pa.large_string())).to_numpy())
        cut = np.minimum(np.searchsorted(at, ends), len(at) - 1)
        if not np.array_equal(at[cut], ends):
            parts = [self.whole(u) for u in missing]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, np.diff(cut, prepend=-1)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by ``end_id``, and the number of ids of each text."""
        if len(self.index) > CACHE_UNITS:
            self.forget()
        index, known = self.index, len(self.index)
        number = index.__getitem__
        extra: list[np.ndarray] = []  # texts that are not made of units, as units of this call
        counts, where = [], []
        for t in texts:
            n = 1
            if self.splits and self.falls_apart(t):
                units = t.replace("\n", " \n").split(" ")
                t, units[0] = units[0], None  # the end, which comes last
                n = len(units)
                place = np.fromiter(map(number, units), np.int64, n)
                place = np.append(place[1:], END)
            else:
                place = np.full(1, END)
            if t:
                where.append(np.full(1, ~len(extra)))
                extra.append(self.head(t))
                n += 1
            where.append(place)
            counts.append(n)
        self.flat[END] = end_id
        self.learn(list(itertools.islice(index, known, None)))
        place = np.concatenate(where) if where else np.zeros(0, np.int64)
        self.seen += np.bincount(place[place >= 0], minlength=len(self.begin))
        more = np.array([len(e) for e in extra], np.int64)
        base = len(self.flat)
        flat = np.concatenate([self.flat, *extra]) if extra else self.flat
        begin = np.concatenate([self.begin, base + np.cumsum(more) - more])
        width = np.concatenate([self.length, more])
        place = np.where(place < 0, len(self.begin) + ~place, place)
        n = width[place]
        upto = np.cumsum(n)
        ids = flat[np.repeat(begin[place] - upto + n, n) + np.arange(upto[-1] if len(upto) else 0)]
        last = np.cumsum(counts) - 1
        per = np.diff(np.concatenate([[0], upto[last]])) if len(last) else np.zeros(0, np.int64)
        return ids, per

    def learn(self, missing: list[str]) -> None:
        if not missing:
            return
        ids, n = self.units([u if u[:1] == "\n" else " " + u for u in missing])
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(n) - n])
        self.length = np.concatenate([self.length, n])
        self.flat = np.concatenate([self.flat, ids])
        self.seen = np.concatenate([self.seen, np.zeros(len(n), np.int64)])

    def forget(self) -> None:
        """Keep the units that come again and again, half of the room at most."""
        least = 2
        while np.count_nonzero(self.seen >= least) > CACHE_UNITS // 2:
            least *= 2
        self.seen[END] = least
        keep = np.flatnonzero(self.seen >= least)
        n, begin = self.length[keep], self.begin[keep]
        upto = np.cumsum(n)
        self.flat = self.flat[np.repeat(begin - upto + n, n) + np.arange(upto[-1])]
        self.begin, self.length, self.seen = upto - n, n, self.seen[keep] // 2
        units = list(self.index)
        self.index = _numbers({units[i]: k for k, i in enumerate(keep.tolist())})

    def reset(self) -> None:
        """Only the end of a document is known. Units are kept without their leading space."""
        self.index = _numbers({None: END})
        self.flat, self.begin, self.length = np.zeros(1, np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)
        self.seen = np.zeros(1, np.int64)
        self.heads: dict[str, np.ndarray] = {}


def _numbers(units: dict) -> collections.defaultdict:
    """``units`` and their numbers; new units are numbered in the order in which they come."""
    return collections.defaultdict(itertools.count(len(units)).__next__, units)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ---- store ------------------------------------------------------------------------------
class _Shard:
    """Cuts the ids of a task into chunks."""

    def __init__(self, shard: int, block: int, layout: str):
        self.shard, self.block, self.layout = shard, block, layout
        self.chunk, self.first = 0, 0
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.docs: list[tuple] = []
        self.end = 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray):
        starts = self.end + np.cumsum(counts) - counts
        self.docs += [(d, int(s), int(n)) for d, s, n in zip(doc_ids, starts, counts)]
        self.end += len(ids)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            yield from self.cut(self.block)

    def cut(self, least: int):
        ids, at, rows = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32), 0, []
        while len(ids) - at >= max(least, 1):
            part = ids[at : at + self.block]
            end, k = self.first + len(part), 0
            while k < len(self.docs) and self.docs[k][1] < end:
                k += 1
            rows.append({
                "shard": self.shard, "chunk": self.chunk, "first_id": self.first, "n_ids": len(part), "layout": self.layout,
                "docs": [{"doc_id": d, "start": s, "n_tokens": n} for d, s, n in self.docs[:k]], "planes": to_planes(part, self.layout),
            })
            whole = k - (1 if k and self.docs[k - 1][1] + self.docs[k - 1][2] > end else 0)
            self.docs = self.docs[whole:]
            at, self.first, self.chunk = at + len(part), end, self.chunk + 1
        self.ids, self.held = [ids[at:]], len(ids) - at
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("layout", pa.string()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))),
    ("planes", pa.list_(pa.binary())),
])


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0,
    layout: str = "byte", block: int = BLOCK,
) -> None:
    """Encode all texts and write them at ``path`` in ascending document order (null first; equal ids by their text).

    Null text is an empty document: its end id only. An empty table makes a table without chunks. Documents meet their
    shard by a range shuffle on the id; a shard is one task's share, streamed chunk by chunk.
    """
    key = F.xxhash64("text").alias("_k")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", key).repartitionByRange("doc_id", "_k").sortWithinPartitions("doc_id", "_k")

    def run(batches):
        from pyspark import TaskContext

        shard, enc = _Shard(TaskContext.get().partitionId(), block, layout), encoder(tokenizer)
        for b in batches:
            for part in small(b, 1024):
                ids, counts = enc.encode(part.column("text").to_pylist(), end_id)
                yield from shard.add(part.column("doc_id").to_pylist(), ids, counts)
        yield from shard.cut(1)

    rows.mapInArrow(run, CHUNKS).write.parquet(os.path.join(path, "chunks"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every stored document: ``start`` counts all ids before it, ``ids`` is binary.

    Chunks are decoded where they lie; only documents that cross a chunk's end are shuffled.
    """
    chunks = spark.read.parquet(os.path.join(path, "chunks"))
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # one row per writing task
    ends = np.cumsum([r["n"] for r in totals]) if totals else np.zeros(0, np.int64)
    base = {r["shard"]: int(e) - r["n"] for r, e in zip(totals, ends)}

    def pieces(crossing):
        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    first, end, before = row["first_id"], row["first_id"] + row["n_ids"], base[row["shard"]]
                    docs = [d for d in row["docs"] if (d["start"] >= first and d["start"] + d["n_tokens"] <= end) != crossing]
                    if not docs:
                        continue
                    raw = from_planes(row["planes"], row["n_ids"], row["layout"]).tobytes()
                    cuts = [(max(d["start"], first), min(d["start"] + d["n_tokens"], end)) for d in docs]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([d["doc_id"] for d in docs], pa.int64()), pa.array([before + d["start"] for d in docs], pa.int64()),
                        pa.array([d["n_tokens"] for d in docs], pa.int64()), pa.array([lo for lo, _ in cuts], pa.int64()),
                        pa.array([raw[4 * (lo - first) : 4 * (hi - first)] for lo, hi in cuts], pa.binary()),
                    ], ["doc_id", "start", "n_tokens", "part", "ids"])

        return chunks.mapInArrow(run, "doc_id long, start long, n_tokens long, part long, ids binary")

    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    split = pieces(True).groupBy("doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("p"))
    return pieces(False).select("doc_id", "start", "n_tokens", "ids").unionByName(split.select("doc_id", "start", "n_tokens", joined.alias("ids")))
