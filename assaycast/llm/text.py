"""Words, hashes and batches shared by the text operators.

A word is a maximal run of bytes other than the six ASCII white-space characters; this is the pattern
``[^\\x20\\x09-\\x0D]+`` on the UTF-8 form. The kernels below work on slices of an Arrow text column as flat
byte arrays; a slice holds whole texts, about ``SLICE_BYTES`` of them, or one longer text.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4_000_000
U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
BYTE_BASE = 0x9E6C63D0876A9A35
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def n_words(text: str | Column) -> Column:
    """Words of a text; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, U(base), U)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n, cached for round sizes."""
    size = 1 << max(n, 1024).bit_length()
    return _powers(base, size), _powers(pow(base, -1, 1 << 64), size)


class Spans:
    """Polynomial hashes of any span of a sequence of numbers, from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int):
        self.power, self.inverse = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * self.power[: len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(U) * GOLDEN)


def gram_hash(x: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of every n consecutive numbers, by doubling."""
    with np.errstate(over="ignore"):
        done, width, out, used = x, 1, None, 0
        left = n
        while left:
            if left & 1:
                if out is None:
                    out, used = done, width
                else:
                    size = min(len(out), len(done) - used)
                    out = out[: max(size, 0)] + U(pow(base, used, 1 << 64)) * done[used : used + max(size, 0)]
                    used += width
            left >>= 1
            if left:
                size = max(len(done) - width, 0)
                done = done[:size] + U(pow(base, width, 1 << 64)) * done[width : width + size]
                width *= 2
        return out


class Words:
    """The words of a slice: ``start`` and ``end`` (bytes), ``first`` (index of the first word of each text)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        self.space = IS_SPACE[data]
        inner = ~self.space
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        before = edge[:-1].copy()
        before[1:] |= self.space[:-1]
        after = edge[1:].copy()
        after[:-1] |= self.space[1:]
        self.inner = inner
        self.start = np.flatnonzero(inner & before)
        self.end = np.flatnonzero(inner & after) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self._bytes = None

    @property
    def bytes(self) -> Spans:
        if self._bytes is None:
            self._bytes = Spans(self.data.astype(U) + U(1), BYTE_BASE)
        return self._bytes

    def hashes(self) -> np.ndarray:
        return self.bytes.hash(self.start, self.end)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self.start))


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last text, bytes and offsets of runs of whole texts."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def text_slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    yield from slices(*flat(batch.column(text)), size)


def pack(texts: list[bytes | None]) -> list[bytes | None]:
    z = zstandard.ZstdCompressor(level=3)
    return [None if t is None else z.compress(t) for t in texts]


def unpack(packed: list[bytes | None]) -> list[bytes]:
    z = zstandard.ZstdDecompressor()
    return [b"" if p is None else z.decompress(p) for p in packed]


def with_packed(df: DataFrame, text: str, out: str) -> DataFrame:
    """``text`` replaced by its zstandard form, which makes a shuffle of texts smaller. Null stays null."""
    fields = [f for f in df.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{out}` binary"])

    def run(batches):
        for b in batches:
            for part in small(b):
                column = pa.array(pack(part.column(text).cast(pa.large_binary()).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in fields] + [column], [f.name for f in fields] + [out])

    return df.mapInArrow(run, schema)


def small(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def trim() -> None:
    """Give free memory back to the system; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of mapInArrow, with ``trim`` after its last batch."""

    def out(batches):
        yield from run(batches)
        trim()

    return out
