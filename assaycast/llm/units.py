"""Results of units of text that come again and again, kept flat under a 64-bit hash of the unit's bytes.

For each kind of result the values of all units lie in one array, with their beginning and length. When there are more
units than ``most``, those seen often stay, half of the room at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from assaycast.llm.text import U, flat, slices

#: Units a worker keeps, about 40 bytes each.
MOST = 1_500_000


class UnitTable:
    def __init__(self, kinds: dict[str, type], most: int = MOST):
        self.most, self.kinds = most, kinds
        self.hash, self.row = np.zeros(0, U), np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int64)
        self.values = {k: np.zeros(0, t) for k, t in kinds.items()}
        self.length = {k: np.zeros(0, np.int32) for k in kinds}
        self.begin = {k: np.zeros(0, np.int64) for k in kinds}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of sorted keys; -1 where there is none."""
        if not len(self.hash):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.hash, keys), len(self.hash) - 1)
        return np.where(self.hash[at] == keys, self.row[at], -1)

    def units(self, h: np.ndarray, learn: Callable[[np.ndarray], dict[str, tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
        """The row of every hash. ``learn`` gets places of units that are not there, each once, and gives values and lengths by kind."""
        self.forget()
        keys, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        row = self.find(keys)
        lost = row < 0
        if lost.any():
            self.add(keys[lost], learn(first[lost]))
            row = self.find(keys)
        self.seen[row] += count
        return row[inverse]

    def add(self, keys: np.ndarray, results: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        rows = np.arange(len(self.seen), len(self.seen) + len(keys))
        place = np.searchsorted(self.hash, keys)
        self.hash, self.row = np.insert(self.hash, place, keys), np.insert(self.row, place, rows)
        self.seen = np.concatenate([self.seen, np.zeros(len(keys), np.int64)])
        for k, (values, length) in results.items():
            self.begin[k] = np.concatenate([self.begin[k], len(self.values[k]) + np.cumsum(length) - length])
            self.values[k] = np.concatenate([self.values[k], values.astype(self.kinds[k], copy=False)])
            self.length[k] = np.concatenate([self.length[k], length.astype(np.int32)])

    def take(self, kind: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``rows`` one after the other, and how many each has."""
        n = self.length[kind][rows].astype(np.int64)
        return self.values[kind][spread(self.begin[kind][rows], n)], n

    def forget(self) -> None:
        if len(self.seen) <= self.most:
            return
        least = 2
        while np.count_nonzero(self.seen >= least) > self.most // 2:
            least *= 2
        keep = np.flatnonzero(self.seen >= least)
        for k in self.kinds:
            self.values[k], n = self.take(k, keep)
            self.length[k], self.begin[k] = n.astype(np.int32), np.cumsum(n) - n
        new = np.full(len(self.seen), -1)
        new[keep] = np.arange(len(keep))
        stays = new[self.row] >= 0
        self.hash, self.row = self.hash[stays], new[self.row[stays]]
        self.seen = self.seen[keep] // 2


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of runs that start at ``begin``."""
    upto = np.cumsum(length)
    return np.repeat(begin - upto + length, length) + np.arange(upto[-1] if len(upto) else 0)


def gather(parts: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several arrays, given as (values, lengths), in another order of all runs."""
    n = np.concatenate([p[1] for p in parts])
    begin = np.cumsum(n) - n
    return np.concatenate([p[0] for p in parts])[spread(begin[order], n[order])], n[order]


def runs_of_texts(batch: pa.RecordBatch, text: str, size: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text, or one longer text, as rows, bytes and offsets."""
    for i, j, data, off in slices(*flat(batch.column(text)), size):
        yield batch.slice(i, j - i), data, off
