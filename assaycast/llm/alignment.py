"""Cross-tokenizer alignment by interval coalescing, with corpus-wide counts of linked ids.

Each token of either tokenizer is an interval of bytes of its text. All tokens are sorted by their start (lexsort), the
running maximum of their ends is taken (maximum.accumulate), and a group ends where a start reaches that maximum: there
both tokenizers end a token. Inside a group the A and B tokens whose bytes overlap are expanded to links.

Texts without two white-space characters in a row fall apart, for both tokenizers, in front of each space and line
feed; such units are aligned once and their groups and links used wherever they come again. Other texts are aligned whole.

Documents are dealt to chunks of about ``CHUNK`` links. A chunk asks once for each id pair that it holds; pairs are counted by the
number of documents that hold them, summed, compared within their A id, and the answers go back to the chunks that asked.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.llm.text import Words
from assaycast.llm.units import UnitTable, gather, runs_of_texts, spread
from assaycast.session import scratch_dir
from assaycast.sources.tables import cut_lineage

CHUNK = 1_000_000
#: A pair of ids as one number: A id times this, and the B id.
PAIR = 1 << 32
SPACE = "▁"
DOCS = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---- interval coalescing ----------------------------------------------------------------
def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray):
    """Group of each A token, group of each B token, and the links as (A token, B token).

    Both cover the same bytes; tokens hold at least one byte each.
    """
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    side = np.repeat([0, 1], [len(start_a), len(start_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    first = np.ones(len(order), bool)
    first[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    # the B tokens that overlap an A token follow each other: from the one that holds its first byte to the one that holds its last
    lo = np.searchsorted(end_b, start_a, side="right")
    n = np.searchsorted(start_b, end_a, side="left") - lo
    links = np.repeat(np.arange(len(start_a)), n), spread(lo, n)
    return group[: len(start_a)], group[len(start_a) :], links


class Pair:
    """Two tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _letter_bytes()
        size = self.a.get_vocab_size(with_added_tokens=True)
        tokens = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.width_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # an id and what may follow it: another id of its side, the other side, the next group
        self.text = [[f"{i}{c}" for i in range(max(size, len(self.bytes_b)))] for c in ",|;"]
        self.apart = self._falls_apart()
        self.table = UnitTable({"size": np.int64, "groups": np.uint8, "links": np.int64}, most=700_000)

    def _falls_apart(self) -> bool:
        """No piece of B has a space or line feed behind another character, and A splits in front of them."""
        inner = re.compile(f"[^{SPACE}].*{SPACE}|.\n", re.S)
        splits = "use_regex': True" in str(self.a.pre_tokenizer) or "use_regex=True" in str(self.a.pre_tokenizer)
        return splits and not any(inner.search(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def ids_a(self, text: str) -> np.ndarray:
        return np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def align(self, texts: list[bytes], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> dict:
        """Groups and links of several texts, one after the other; a, b: ids and their number for each text.

        ``size`` has four numbers a text: A tokens, B tokens, groups and links; all are -1 where the bytes of either side
        are not the text's.
        """
        want = b"".join(texts)
        size = np.array([len(t) for t in texts], np.int64)
        ok = self._covers(want, size, a, self.bytes_a, self.width_a) & self._covers(want, size, b, self.bytes_b, self.width_b)
        (ids_a, n_a), (ids_b, n_b) = (gather([x], np.flatnonzero(ok)) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        starts_a, starts_b = ends_a - self.width_a[ids_a], ends_b - self.width_b[ids_b]
        group_a, group_b, (link_a, link_b) = coalesce(starts_a, ends_a, starts_b, ends_b)
        # A tokens of a group, then its B tokens
        order = np.lexsort((np.repeat([0, 1], [len(ids_a), len(ids_b)]), np.concatenate([group_a, group_b])))
        ids = np.concatenate([ids_a, ids_b])[order]
        group, side = np.concatenate([group_a, group_b])[order], (order >= len(ids_a)).astype(np.int64)
        after = np.zeros(len(ids), np.int64)
        after[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        after[-1:] = 2
        words = [self.text[k][i] for k, i in zip(after.tolist(), ids.tolist())]
        width = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        count = lambda x: np.bincount(x, minlength=len(n_a))
        chars = np.bincount(np.concatenate(owner)[order], weights=width, minlength=len(n_a)).astype(np.int64)
        ends = np.concatenate([[-1], np.flatnonzero(after == 2)])
        n_groups = count(owner[1][np.searchsorted(group_b, np.arange(len(ends) - 1))]) if len(ids) else n_a
        n_links = count(owner[0][link_a])
        sizes = np.full((len(texts), 4), -1, np.int64)
        sizes[ok] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        every = lambda n: np.bincount(np.flatnonzero(ok), weights=n, minlength=len(texts)).astype(np.int64)
        return {
            "size": (sizes.ravel(), np.full(len(texts), 4, np.int64)),
            "groups": (np.frombuffer("".join(words).encode(), np.uint8), every(chars)),
            "links": (ids_a[link_a] * PAIR + ids_b[link_b], every(n_links)),
        }

    @staticmethod
    def _covers(want: bytes, size: np.ndarray, tokens: tuple[np.ndarray, np.ndarray], raw: list[bytes], width: np.ndarray) -> np.ndarray:
        ids, n = tokens
        got = b"".join([raw[i] for i in ids.tolist()])
        bytes_of = np.add.reduceat(np.append(width[ids], 0), np.minimum(np.cumsum(n) - n, len(ids))) * (n > 0) if len(n) else np.zeros(0, np.int64)
        same = bytes_of == size
        if same.all() and got == want:
            return same
        end, at = np.cumsum(size), np.cumsum(bytes_of)
        return np.array([s and got[y - m : y] == want[z - m : z] for s, y, z, m in zip(same, at.tolist(), end.tolist(), size.tolist())], bool)

    def whole(self, texts: list[str]) -> dict:
        """``align`` of whole texts, which get a space in front."""
        a = [self.ids_a(" " + t) for t in texts]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        flat = lambda parts: (np.concatenate([np.zeros(0, np.int64), *parts]), np.array([len(p) for p in parts], np.int64))
        return self.align([(" " + t).encode() for t in texts], flat(a), flat(b))

    def whole_units(self, units: list[str]) -> dict:
        """``align`` of units that begin with one space or line feed and hold no other."""
        ids = self.ids_a("".join(units))
        texts = [u.encode() for u in units]
        ends, at = np.cumsum([len(t) for t in texts]), np.cumsum(self.width_a[ids])
        cut = np.searchsorted(at, ends)
        if len(cut) and (cut[-1] >= len(at) or not np.array_equal(at[cut], ends)):
            raise ValueError("the tokenizer joins what stands around a space")
        n_a = np.diff(cut, prepend=-1)
        # B puts a space in front: the unit's own, or one that goes again
        parts = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for k, u in enumerate(units):
            if u[0] != " ":
                parts[k] = parts[k][1:]
        n_b = np.fromiter(map(len, parts), np.int64, len(parts))
        return self.align(texts, (ids, n_a), (np.fromiter((i for p in parts for i in p), np.int64, n_b.sum()), n_b))


#: White space that units do not hold: anything but single spaces and line feeds between other characters.
UNSAFE = re.compile(r"[^\S \n]|[\x1c-\x1f]|\s\s|\s\Z")


def aligned(pair: Pair, texts: list[str]):
    """For each text: sizes (A tokens, B tokens, groups, links), groups as text, and all links in a row with their number.

    A text that is empty, or whose tokens do not give back its bytes, has none.
    """
    n = len(texts)
    sizes, groups = np.zeros((n, 4), np.int64), [b""] * n
    safe = [pair.apart and bool(t) and not UNSAFE.search(" " + t) for t in texts]
    kinds = [k for k in range(n) if safe[k]]
    link_parts = []
    if kinds:
        raw = [(" " + texts[k]).encode() for k in kinds]
        data = np.frombuffer(b"".join(raw), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        words = Words(data, off)
        start = words.start - 1  # with the space or line feed in front

        def learn(places: np.ndarray) -> dict:
            size = words.end[places] - start[places]
            text = data[spread(start[places], size)].tobytes()
            ends = np.cumsum(size).tolist()
            return pair.whole_units([text[a:z].decode() for a, z in zip([0, *ends], ends)])

        rows = pair.table.units(words.bytes.hash(start, words.end), learn)
        own = pair.table.take("size", rows)[0].reshape(-1, 4)
        upto = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(own, axis=0)])
        sums = upto[words.first[1:]] - upto[words.first[:-1]]
        lost = np.concatenate([[0], np.cumsum(own[:, 0] < 0)])
        good = lost[words.first[1:]] == lost[words.first[:-1]]
        chars, n_chars = pair.table.take("groups", rows)
        at = np.concatenate([[0], np.cumsum(n_chars)])[words.first]
        line = chars.tobytes()
        links, n_links = pair.table.take("links", rows)
        links_at = np.concatenate([[0], np.cumsum(n_links)])[words.first]
        for j, k in enumerate(kinds):
            if good[j]:
                sizes[k], groups[k] = sums[j], line[at[j] : at[j + 1] - 1]
                link_parts.append((k, links[links_at[j] : links_at[j + 1]]))
            else:  # a unit that does not give back its bytes: look at the whole text
                safe[k] = False
    rest = [k for k in range(n) if not safe[k] and texts[k]]
    if rest:
        out = pair.whole([texts[k] for k in rest])
        own = out["size"][0].reshape(-1, 4)
        line, at = out["groups"][0].tobytes(), np.concatenate([[0], np.cumsum(out["groups"][1])])
        links_at = np.concatenate([[0], np.cumsum(out["links"][1])])
        for j, k in enumerate(rest):
            if own[j, 0] >= 0:
                sizes[k], groups[k] = own[j], line[at[j] : at[j + 1] - 1]
                link_parts.append((k, out["links"][0][links_at[j] : links_at[j + 1]]))
    link_parts.sort(key=lambda p: p[0])
    return sizes, groups, np.concatenate([np.zeros(0, np.int64), *(p[1] for p in link_parts)]), sizes[:, 3]


def _letter_bytes() -> dict[str, int]:
    """The byte for each letter of byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(0x100 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


# ---- corpus -----------------------------------------------------------------------------
class _Chunk:
    """Documents of a task until they hold enough links."""

    def __init__(self, number: int):
        self.number = number
        self.rows: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def cut(self):
        """A row for each document, with its distinct pairs as places in the chunk's list, and a last row with that list."""
        z = zstandard.ZstdCompressor(level=1)
        n = np.concatenate([np.zeros(0, np.int64), *self.counts])
        pairs, place = np.unique(np.concatenate([np.zeros(0, np.int64), *self.links]), return_inverse=True)
        own, times = np.unique(np.repeat(np.arange(len(n)), n) * max(len(pairs), 1) + place, return_counts=True)
        owner, place = own // max(len(pairs), 1), own % max(len(pairs), 1)
        docs = np.bincount(place, minlength=len(pairs))
        at = np.searchsorted(owner, np.arange(len(n) + 1))
        rows = {k.split()[0]: [] for k in DOCS.split(", ")}
        for j, row in enumerate(self.rows):
            lo, hi = at[j], at[j + 1]
            packed = [z.compress(v[lo:hi].astype("<u4").tobytes()) for v in (place, times)]
            for k, v in zip(rows, (self.number, *row, *packed)):
                rows[k].append(v)
        kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
        cols = [pa.array(v, t) for v, t in zip(rows.values(), kinds)]
        nothing = pa.array([None] * len(self.rows), pa.list_(pa.int64()))
        names = [*rows, "asked", "holders"]
        yield pa.RecordBatch.from_arrays([*cols, nothing, nothing], names)
        for i in range(0, len(pairs), 200_000):
            lists = [pa.array([v[i : i + 200_000]], pa.list_(pa.int64())) for v in (pairs, docs)]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([self.number] + [None] * 8, kinds)] + lists, names)


def align_documents(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK,
    with_groups: str | None = None,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is a byte-level ``tokenizers`` file, B a ``sentencepiece`` file that puts a space in front, so A gets one as well. Strings of
    special tokens are plain text. Texts that are null or empty, or that either tokenizer does not give back byte by
    byte, have no tokens: zeros and the text ''. Null ids and rows that repeat are documents of their own. ``n_best`` counts the links
    whose pair is held by as many documents as any pair of the same A id. ``with_groups`` is a folder that gets the alignment
    itself: ``doc_id, groups`` with groups as ``a1,a2|b1;a3|b2,b3``. An empty table gives no rows.
    """
    spark = docs.sparkSession

    def run(batches):
        from pyspark import TaskContext

        pair, task = tokenizer_pair(tokenizer_a, tokenizer_b), TaskContext.get().partitionId() << 32
        now = _Chunk(task)
        for b in batches:
            for part, _, _ in runs_of_texts(b, "text", 1_000_000):
                sizes, groups, links, counts = aligned(pair, part.column("text").to_pylist())
                ids, at = part.column("doc_id").to_pylist(), np.concatenate([[0], np.cumsum(counts)])
                lo = 0
                while lo < len(ids):  # up to the document that fills the chunk
                    hi = min(len(ids), int(np.searchsorted(at, at[lo] + chunk - now.held)) + (now.held == 0))
                    hi = max(hi, lo + (now.held == 0))
                    now.rows += [
                        (d, *s, hashlib.sha256(g).hexdigest() if s[0] else "") for d, s, g in zip(ids[lo:hi], sizes[lo:hi].tolist(), groups[lo:hi])
                    ]
                    now.links.append(links[at[lo] : at[hi]])
                    now.counts.append(counts[lo:hi])
                    now.held += int(at[hi] - at[lo])
                    lo = hi
                    if now.held >= chunk or (lo < len(ids) and now.held):
                        yield from now.cut()
                        now = _Chunk(now.number + 1)
        if now.rows:
            yield from now.cut()

    def spell(batches):
        pair = tokenizer_pair(tokenizer_a, tokenizer_b)
        for b in batches:
            for part, _, _ in runs_of_texts(b, "text", 1_000_000):
                groups = [g.decode() for g in aligned(pair, part.column("text").to_pylist())[1]]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(groups, pa.string())], ["doc_id", "groups"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if with_groups:
        rows.mapInArrow(spell, "doc_id long, groups string").write.parquet(with_groups)
    path = os.path.join(scratch_dir(spark, "alignment"), "chunks")
    rows.mapInArrow(run, f"{DOCS}, asked array<long>, holders array<long>").write.parquet(path)
    stored = spark.read.parquet(path)
    asked = stored.where("asked is not null").select("chunk", F.explode(F.arrays_zip("asked", "holders")).alias("p"))
    asked = asked.select("chunk", F.col("p.asked").alias("pair"), F.col("p.holders").alias("docs"))
    counts = pair_counts(asked)
    answers = asked.select("chunk", "pair").join(cut_lineage(counts, "pair-counts"), "pair")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        z = zstandard.ZstdDecompressor()
        right = right.sort_by("pair")
        count, best = right["docs"].to_numpy(), right["best"].to_numpy().astype(np.int64)
        n_best, total = [], []
        for p, t in zip(left["pairs"].to_pylist(), left["times"].to_pylist()):
            place, times = (np.frombuffer(z.decompress(x), "<u4").astype(np.int64) for x in (p, t))
            n_best.append(int((best[place] * times).sum()))
            total.append(int((count[place] * times).sum()))
        new = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table([new[c] if c in new else left[c] for c in names], names)

    # read anew: a cogroup of one relation with itself is ambiguous
    held = spark.read.parquet(path).where("pairs is not null").drop("asked", "holders")
    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(look_up, FOUND)


def pair_counts(asked: DataFrame) -> DataFrame:
    """``pair, docs, best``: documents that hold each id pair, and whether no pair of the same A id has more."""
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    # one row for each id of A's vocabulary
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
