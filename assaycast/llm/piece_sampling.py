"""Sampled segmentation over the piece lattice: forward filtering, backward sampling.

A text falls into units: a run of spaces with the characters after it, up to the next space or line feed; no piece
crosses a unit, so the lattice of a text is a chain of small lattices. The forward pass sums, over all
segmentations, the weights of the pieces up to each character; the backward pass draws the last piece in
proportion to them, then the one before, to the unit's start. Every draw is a hash of seed, row key, unit
number and step, so a row's segmentation depends on nothing else. Spaces are written as U+2581; characters that no
piece covers, and U+2581 itself, become byte pieces, so decoding gives back every text.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.llm.text import GOLDEN, U, mix, powers, small, trimmed

SPACE = "▁"
CODE_BASE = 0xD6E8FEB86659FD93
UNITS = re.compile(r" *[^ \n]+| +|\n")
#: Sharpness: a piece weighs its probability to this power.
ALPHA = 1.0


class Lattice:
    """The pieces of a ``sentencepiece`` file, and sampling from the lattices of many units at once.

    A BPE file ranks its pieces and has no probabilities: the piece of rank r gets one in proportion to
    1 / (r + 10), a byte piece a hundredth of the rarest one.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id = np.zeros(256, np.int64)
        pieces = []
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.raw[i] = piece.replace(SPACE, " ").encode()
                pieces.append((i, piece.replace(SPACE, " "), -sp.get_score(i)))
        ranks = np.array([p[2] for p in pieces])
        logp = -np.log(ranks - ranks.min() + 10.0)
        logp -= np.log(np.exp(logp).sum())
        self.byte_logp = logp.min() + np.log(0.01)
        self.longest = max(len(p[1]) for p in pieces)
        self.base = powers(CODE_BASE, self.longest)[0]
        self.tables = []  # for each length the heads of pieces: key, piece (-2: a head only), log-probability
        text = {p[1]: k for k, p in enumerate(pieces)}
        for length in range(1, self.longest + 1):
            heads = sorted({p[:length] for p in text if len(p) >= length})
            codes = np.frombuffer("".join(heads).encode("utf-32-le"), np.uint32).reshape(len(heads), length).astype(U) + U(1)
            keys = mix((codes * self.base[:length]).sum(1, dtype=U))
            order = np.argsort(keys)
            found = np.array([text.get(h, -1) for h in heads])[order]
            ids = np.where(found < 0, -2, np.array([p[0] for p in pieces])[found])
            self.tables.append((keys[order], ids, np.where(found < 0, 0.0, logp[found])))

    def edges(self, codes: np.ndarray, left: np.ndarray):
        """Start, length, piece and log-probability of every piece at every place; ``left``: characters to the unit's end."""
        out = []
        x = codes + U(1)
        at, h = np.arange(len(codes)), np.zeros(len(codes), U)
        for n, (keys, ids, logp) in enumerate(self.tables):
            inside = left[at] > n
            at, h = at[inside], h[inside]
            if not len(at):
                break
            h = h + x[at + n] * self.base[n]
            key = mix(h)
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[k] == key
            at, h, k = at[hit], h[hit], k[hit]
            whole = ids[k] >= 0
            out.append((at[whole], np.full(np.count_nonzero(whole), n + 1), ids[k][whole], logp[k][whole]))
        start, length, piece, logp = (np.concatenate(c) for c in zip(*out))
        lone = np.ones(len(codes), bool)
        lone[start[length == 1]] = False
        lone |= codes == ord(SPACE)
        at = np.flatnonzero(lone)  # characters without a piece of their own: byte pieces, id -1 for now
        width = 1 + (codes[at] > 0x7F) + (codes[at] > 0x7FF) + (codes[at] > 0xFFFF)
        ones = np.ones(len(at), np.int64)
        return (
            np.concatenate([start, at]), np.concatenate([length, ones]), np.concatenate([piece, -ones]),
            np.concatenate([logp, width * self.byte_logp]),
        )

    def prepare(self, units: list[str], alpha: float = ALPHA) -> "Tables":
        """Forward pass over distinct units."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        longest_first = np.argsort(-size, kind="stable")
        units, size = [units[i] for i in longest_first], size[longest_first]
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        end = np.cumsum(size)
        place = np.arange(len(codes)) - np.repeat(end - size, size)
        start, length, piece, logp = self.edges(codes, np.repeat(size, size) - place)
        # a state is (characters done, unit), numbered in this order: the units of at least d characters come first
        reach = np.searchsorted(-size, -np.arange(size[0] + 1), side="right")
        offset = np.cumsum(reach) - reach
        unit = np.repeat(np.arange(len(units)), size)
        state = offset[place[start]] + unit[start]
        to = offset[place[start] + length] + unit[start]
        # within a state the longest piece first, so that the order is the same in any company of units
        order = len(to) - 1 - np.argsort(to[::-1], kind="stable")
        state, to, piece, logp = state[order], to[order], piece[order], alpha * logp[order]
        states = int(reach.sum())
        forward = np.zeros(states)
        weight = np.empty(len(to))
        heads = np.flatnonzero(np.diff(to, prepend=-1))
        cuts = np.searchsorted(to, offset[1:])
        head_cuts = np.searchsorted(heads, cuts)
        for d, a in enumerate(cuts):
            b = cuts[d + 1] if d + 1 < len(cuts) else len(to)
            own = heads[head_cuts[d] : head_cuts[d + 1] if d + 1 < len(cuts) else len(heads)] - a
            w = forward[state[a:b]] + logp[a:b]
            runs = np.diff(np.append(own, b - a))
            top = np.maximum.reduceat(w, own)
            total = top + np.log(np.add.reduceat(np.exp(w - np.repeat(top, runs)), own))
            forward[to[a:b][own]] = total
            weight[a:b] = np.exp(w - np.repeat(total, runs))
        begin = np.zeros(states + 1, np.int64)
        np.cumsum(np.bincount(to, minlength=states), out=begin[1:])
        code = np.zeros(states, np.int64)  # the character before a state, for byte pieces
        code[offset[place + 1] + unit] = codes
        last = np.empty(len(units), np.int64)
        last[longest_first] = offset[size] + np.arange(len(units))
        return Tables(last, begin, state, piece, weight, len(units), code[to])


class Tables:
    """Backward distributions: the edges into state s are those from ``begin[s]`` on, of chance ``weight`` each.

    States below ``roots`` are the starts of the units."""

    def __init__(self, last, begin, source, piece, weight, roots, code):
        self.last, self.begin, self.source, self.piece, self.weight, self.roots, self.code = last, begin, source, piece, weight, roots, code

    def sample(self, unit: np.ndarray, seed: np.ndarray):
        """Number of the unit, step and edge of each drawn piece, steps from the end of the unit back; ``seed``: one per unit."""
        at, live, step = self.last[unit], np.arange(len(unit)), 0
        out = []
        while len(live):
            r = mix(seed[live] + GOLDEN * np.full(1, step + 1, U))
            edge, final = self.begin[at], self.begin[at + 1] - 1
            rest = ((r >> U(11)).astype(np.float64) + 0.5) / 2.0**53 - self.weight[edge]
            go = np.flatnonzero((rest > 0) & (edge < final))
            while len(go):
                edge[go] += 1
                rest[go] -= self.weight[edge[go]]
                go = go[(rest[go] > 0) & (edge[go] < final[go])]
            out.append((live, np.full(len(live), step), edge))
            at = self.source[edge]
            more = at >= self.roots
            live, at, step = live[more], at[more], step + 1
        return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def row_seeds(keys: list, seed: int) -> np.ndarray:
    """A 64-bit number per row key; null counts as a key of its own."""
    values = np.fromiter((0 if k is None else k & (2**64 - 1) for k in keys), U, len(keys))
    return mix(mix(values + GOLDEN) + np.fromiter((k is None for k in keys), U, len(keys)) * U(3) + U(seed) * GOLDEN)


def encode(model: Lattice, texts: list[str], keys: list, seed: int = 0, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and how many each has."""
    index: dict[str, int] = {}
    unit, counts = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        parts = UNITS.findall(t)
        counts[i] = len(parts)
        unit.extend([index.setdefault(p, len(index)) for p in parts])
    if not index:
        return np.zeros(0, np.int32), counts
    tables = model.prepare(list(index), alpha)
    unit = np.array(unit, np.int64)
    number = np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts)
    seeds = mix(np.repeat(row_seeds(keys, seed), counts) + (number + 1).astype(U) * U(0xD1342543DE82EF95))
    who, step, edge = tables.sample(unit, seeds)
    pieces = tables.piece[edge]
    # byte pieces: as many ids as the character has bytes
    width = np.ones(len(pieces), np.int64)
    lone = np.flatnonzero(pieces < 0)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in tables.code[edge[lone]]]
    width[lone] = [len(r) for r in raw]
    order = np.lexsort((-step, who))
    ids = np.repeat(pieces[order], width[order])
    if len(lone):
        ids[ids < 0] = np.concatenate([model.byte_id[np.frombuffer(raw[k], np.uint8)] for k in np.argsort(np.argsort(order)[lone])])
    per_unit = np.bincount(who, weights=width, minlength=len(unit)).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(per_unit)])
    ends = np.cumsum(counts)
    return ids.astype(np.int32), sums[ends] - sums[ends - counts]


def decode(model: Lattice, ids) -> str:
    return b"".join([model.raw[i] for i in ids]).decode("utf-8", "surrogatepass")


def sample_pieces(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0, alpha: float = ALPHA, keep: tuple | list = (),
) -> DataFrame:
    """``key, *keep, ids, n_pieces, lossless`` of every row: the drawn piece ids, and whether decoding them gave back the text.

    The key is an integer; the columns ``keep`` come along. Null and empty texts have no ids. Rows that repeat get the same
    ids; a null key is a key. A single unit without spaces may be of any length; time and memory are in proportion.
    """
    along = [key, *keep]
    rows = docs.select(*[F.col(f"`{c}`") for c in along], F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in along)

    def run(batches):
        m = lattice(model)
        for b in batches:
            for part in small(b, 1024):
                keys, texts = part.column("_key").to_pylist(), [t or "" for t in part.column("_text").to_pylist()]
                ids, n = encode(m, texts, keys, seed, alpha)
                off = np.concatenate([[0], np.cumsum(n)])
                same = [decode(m, ids[a:z].tolist()) == t for a, z, t in zip(off[:-1], off[1:], texts)]
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in along), lists, pa.array(n), pa.array(same)], [*along, "ids", "n_pieces", "lossless"])

    return rows.mapInArrow(trimmed(run), f"{schema}, ids array<int>, n_pieces long, lossless boolean")
