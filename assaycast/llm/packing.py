"""Best-fit packing of token sequences, repacked until lower bounds certify it.

Documents become token ids and an end id; what is longer than a sequence is cut, and a full piece is a sequence of
its own. The other pieces are dealt at random to partitions, each packed by best-fit decreasing. Dual-feasible functions give
every partition a lower bound of its sequences; a partition that needs more than its bound has a gap. Partitions with gaps hand
out their emptiest sequences, which meet those of ``FAN`` such partitions and are packed again by best-fit
decreasing; the new packing stands if it needs fewer sequences. Rounds go on until no gap is left or the whole table meets its
bound. Only the pieces of handed-out sequences move after the first round.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.llm.text import Words
from assaycast.llm.units import UnitTable, gather, runs_of_texts, spread
from assaycast.sources.tables import cut_lineage

LIMIT = 2048
#: Pieces of a partition, on average.
PART = 16_384
#: Partitions whose open sequences meet in a round.
FAN = 8
#: Dual-feasible functions u(k) for k up to this.
STEPS = 40
PIECES = "number long, doc_id long, piece int, start long, length int, crc long"
PLACED = f"{PIECES}, round int, part long, home long, bin int, offset int, give boolean"


# ---- token ids --------------------------------------------------------------------------
class WordEncoder:
    """Ids of texts under a tokenizer that drops white space; repeated words are encoded once.

    White space splits every text before its words are looked at, so words encode alone as they do in place. A word of
    Latin letters, maybe with one mark after it, is one merge sequence and one mark: such words go to the merges
    directly, in lower case, many at once; all others through the whole tokenizer.
    """

    #: Letters and a mark, or another word; one word a line.
    LINE = re.compile("([a-zA-ZÀ-ÖØ-Þß-öø-ÿ]+)([.,;:!?]?)\n|(.*)\n")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.drops_space = self.ids("a b").tolist() == self.ids(" a\n\tb ").tolist()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.mark = {m: self.ids(m) for m in ".,;:!?"}
        lower = getattr(self.tokenizer.model, "end_of_word_suffix", None) == "</w>" and self.ids("ABÉ").tolist() == self.ids("abé").tolist()
        self.simple = self.drops_space and lower and all(len(i) == 1 for i in self.mark.values())
        self.cut = next((t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip or t.normalized)), None)
        self.letters = _byte_letters()
        self.table = UnitTable({"ids": np.uint32})

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if not self.drops_space:
            parts = [self.ids(data[a:z].tobytes().decode()) for a, z in zip(off, off[1:])]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(p) for p in parts], np.int64)
        words = Words(data, off)

        def learn(places: np.ndarray):
            start, size = words.start[places], words.end[places] - words.start[places]
            line = np.full(size.sum() + len(places), 10, np.uint8)  # one word a line
            ends = np.cumsum(size + 1)
            line[spread(ends - size - 1, size)] = data[spread(start, size)]
            return {"ids": self.encode_words(line.tobytes().decode())}

        rows = self.table.units(words.hashes(), learn)
        ids, n = self.table.take("ids", rows)
        upto = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(upto[words.first])

    def encode_words(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one a line."""
        found = self.LINE.findall(lines) if self.simple else [("", "", w) for w in lines.split("\n")[:-1]]
        known: dict[str, int] = {}
        stem = np.array([known.setdefault(w.lower(), len(known)) for w, _, _ in found if w], np.int64)
        ids, n = self.merge_words(list(known))
        if len(n) != len(known):
            raise ValueError("the vocabulary does not end each word with </w>")
        ids, n = gather([(ids, n)], stem)
        marked = np.array([bool(m) for w, m, _ in found if w], bool)
        ids = np.insert(ids, np.cumsum(n)[marked], np.array([self.mark[m][0] for _, m, _ in found if m], np.uint32))
        plain = np.array([bool(w) for w, _, _ in found], bool)
        order = np.empty(len(found), np.int64)
        order[plain], order[~plain] = np.arange(len(stem)), np.arange(len(stem), len(found))
        return gather([(ids, n + marked), self.whole_words([w for _, _, w in found if w])], order)

    def whole_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of other words: in a row with the special token between them, or alone if they hold one."""
        cut = self.cut or ""
        alone = [k for k, w in enumerate(words) if cut in w]
        joined = [w for w in words if cut not in w]
        ids = self.ids(cut.join(joined)) if joined else np.zeros(0, np.uint32)
        between = ids == self.tokenizer.token_to_id(cut) if joined else np.zeros(0, bool)
        n = np.diff(np.append(np.flatnonzero(between), len(ids)), prepend=-1) - 1 if joined else np.zeros(0, np.int64)
        parts = [self.ids(words[k]) for k in alone]
        order = np.empty(len(words), np.int64)
        is_alone = np.zeros(len(words), bool)
        is_alone[alone] = True
        order[~is_alone], order[is_alone] = np.arange(len(joined)), np.arange(len(joined), len(words))
        rest = np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(p) for p in parts], np.int64)
        return gather([(ids[~between], n), rest], order)

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        line = self.letters[np.frombuffer(" ".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)


def _byte_letters() -> np.ndarray:
    """The letter for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on; spaces stay."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    letters = np.arange(256, dtype="<u4")
    letters[rest] = 0x100 + np.arange(len(rest))
    letters[0x20] = 0x20
    return letters


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """``number, doc_id, piece, start, length, crc`` (and ``ids``, little-endian 32-bit) of every piece; ``number`` is unique."""

    def run(batches):
        from pyspark import TaskContext

        enc, at = word_encoder(tokenizer), TaskContext.get().partitionId() << 34
        for b in batches:
            for part, data, off in runs_of_texts(b, "text"):
                ids, n = enc.encode(data, off)
                # the end id behind each text
                raw = np.insert(ids, np.cumsum(n), np.uint32(end_id)).astype("<u4").tobytes()
                cols = [[] for _ in range(6)]
                base, out = 0, []
                for d, size in zip(part.column("doc_id").to_pylist(), (n + 1).tolist()):
                    for k, s in enumerate(range(0, size, limit)):
                        length = min(limit, size - s)
                        own = raw[4 * (base + s) : 4 * (base + s + length)]
                        for c, v in zip(cols, (at, d, k, s, length, zlib.crc32(own))):
                            c.append(v)
                        if with_ids:
                            out.append(own)
                        at += 1
                    base += size
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                names = ["number", "doc_id", "piece", "start", "length", "crc"]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(out, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


# ---- packing ----------------------------------------------------------------------------
def best_fit_decreasing(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length, and the number of bins: longest first, each into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int32), np.zeros(len(lengths), np.int32)
    room: list[list[int]] = [[] for _ in range(limit + 1)]  # bins by free tokens
    open_rooms, count = 0, 0  # bit r: some bin has r free tokens
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = limit, count
            count += 1
        bins[i], offsets[i] = b, limit - r
        if r > size:
            room[r - size].append(b)
            open_rooms |= 1 << (r - size)
    return bins, offsets, count


def lower_bound(counts: np.ndarray, limit: int = LIMIT) -> float:
    """The largest bound of dual-feasible functions; counts: pieces of each length from 0 to ``limit``.

    A function f with f(x1) + ... + f(xn) <= 1 wherever x1 + ... + xn <= 1 turns any packing of the pieces into one of their
    images, so the sum of the images bounds the bins. Used: pieces above 1 - t count whole and those below t
    not at all, for every t up to a half (t = 0 is the sum of the lengths); and u(k), which rounds down to
    multiples of 1 / k what is no multiple of 1 / (k + 1). Round up for a number of bins.
    """
    c = counts.astype(np.int64)
    x = np.arange(limit + 1, dtype=np.int64)
    pieces, tokens = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])
    t = np.arange(limit // 2 + 1)
    whole = pieces[-1] - pieces[limit - t + 1]
    middle = tokens[limit - t + 1] - tokens[t]
    best = float((limit * whole + middle).max()) / limit
    for k in range(1, STEPS + 1):
        scaled = (k + 1) * x
        image = np.where(scaled % limit == 0, x * k, scaled // limit * limit)
        best = max(best, int((image * c).sum()) / (limit * k))
    return best


def needed(bound: float) -> int:
    return int(np.ceil(bound - 1e-9))


def _emptiest(bins: np.ndarray, lengths: np.ndarray, limit: int) -> np.ndarray:
    """Which pieces lie in the sequences to hand out: none without a gap, else twice as many as the gap and two."""
    fill = np.bincount(bins, weights=lengths)
    gap = len(fill) - lower_bound(np.bincount(lengths, minlength=limit + 1), limit)
    if gap < 1e-9:
        return np.zeros(len(bins), bool)
    n = min(len(fill), 2 * int(np.ceil(gap)) + 2)
    out = np.zeros(len(fill), bool)
    out[np.argsort(fill, kind="stable")[:n]] = True
    return (out & (fill < limit))[bins]


def _table(t: pa.Table, **new: np.ndarray) -> pa.Table:
    names = [c.split()[0] for c in PLACED.split(", ")]
    return pa.table([pa.array(new[c]) if c in new else t[c] for c in names], names)


def _packed(limit: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("number")
        lengths = t["length"].to_numpy()
        bins, offsets, _ = best_fit_decreasing(lengths, limit)
        return _table(
            t, round=np.zeros(len(bins), np.int32), home=t["part"].to_numpy(), bin=bins, offset=offsets, give=_emptiest(bins, lengths, limit)
        )

    return run


def _repacked(round_: int, limit: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("number")
        lengths = t["length"].to_numpy()
        old = np.unique(np.stack([t[c].to_numpy().astype(np.int64) for c in ("round", "home", "bin")]), axis=1, return_inverse=True)[1].ravel()
        bins, offsets, count = best_fit_decreasing(lengths, limit)
        if count > old.max():  # no fewer than before: the old sequences stand
            return _table(t, give=_emptiest(old, lengths, limit))
        return _table(
            t, round=np.full(len(bins), round_, np.int32), home=t["part"].to_numpy(), bin=bins, offset=offsets, give=_emptiest(bins, lengths, limit)
        )

    return run


def pack_pieces(pieces: DataFrame, limit: int = LIMIT, per_part: int = PART, fan: int = FAN) -> DataFrame:
    """``number, doc_id, piece, start, length, crc, sequence_id, offset`` of every piece of ``token_pieces``.

    ``pieces`` must be a stored table, so that numbers stay as they are. Lengths must be from 1 to ``limit``.
    """
    cols = [c.split()[0] for c in PIECES.split(", ")]
    full = pieces.where(F.col("length") >= limit).select(*cols, (F.col("number") * 2 + 1).alias("sequence_id"), F.lit(0).alias("offset"))
    small = pieces.where(F.col("length") < limit)
    histogram = np.zeros(limit + 1, np.int64)
    for r in small.groupBy("length").count().collect():  # one row per length, at most ``limit``
        histogram[r["length"]] = r["count"]
    n = int(histogram.sum())
    if not n:
        return full
    bound = needed(lower_bound(histogram, limit))
    parts = max(1, -(-n // per_part))
    dealt = small.select(*cols, F.pmod(F.xxhash64("number"), F.lit(parts)).alias("part"))
    placed = cut_lineage(dealt.groupBy("part").applyInArrow(_packed(limit), PLACED), "packed")
    settled, round_ = [], 0
    sequences = _sequences(placed)
    while parts > 1 and sequences > bound:
        round_, before = round_ + 1, parts
        settled.append(placed.where("not give"))
        given = placed.where("give").withColumn("part", F.floor(F.col("part") / fan))
        held = _sequences(given)
        placed = cut_lineage(given.groupBy("part").applyInArrow(_repacked(round_, limit), PLACED), "packed")
        sequences -= held - _sequences(placed)
        parts = -(-before // fan)
    out = placed
    for s in settled:
        out = out.unionByName(s)
    # rounds, homes and bins as one number; rounds are fewer than 64, and no home has 2**20 bins
    own = ((F.col("home") * 64 + F.col("round")) * (1 << 20) + F.col("bin")) * 2
    return out.select(*cols, own.alias("sequence_id"), "offset").unionByName(full)


def _sequences(placed: DataFrame) -> int:
    return placed.agg(F.count(F.when(F.col("offset") == 0, 1))).first()[0]


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end_id: int = 0,
    per_part: int = PART, fan: int = FAN,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: where every piece of every document lies.

    A null or empty text is its end id alone; a null id and rows that repeat are documents of their own; other
    columns are not read. A text of any length is cut into pieces; a piece of exactly ``limit`` tokens is a sequence alone.
    An empty table gives no rows. Numbers of sequences are unique and have gaps.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer, doc_id, text, limit, end_id), "pieces")
    placed = pack_pieces(pieces, limit, per_part, fan)
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, doc_ids, ids``: the packed sequences themselves; pieces: a stored table with ids."""
    met = placed.select("number", "sequence_id", "offset").join(pieces.select("number", "doc_id", "length", "ids"), "number")
    own = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    packed = met.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), own.alias("p"))
    return packed.select("sequence_id", "n_tokens", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), joined.alias("ids"))


def certificate(placed: DataFrame, limit: int = LIMIT) -> tuple[int, int]:
    """Sequences in use, and the number that no packing of the same pieces can undercut."""
    histogram = np.zeros(limit + 1, np.int64)
    for r in placed.groupBy("length").count().collect():  # one row per length
        histogram[r["length"]] = r["count"]
    return _sequences(placed), needed(lower_bound(histogram, limit))
