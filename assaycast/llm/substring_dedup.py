"""Substring dedup by seed and extend on winnowed anchors.

Every window of ``length`` words picks one of its ``seed``-word grams as its anchor (the least hash, the last one
of equals), so equal windows pick equal anchors at equal offsets. Neighbouring windows with one anchor form a run;
the run's words are the anchor extended both ways, and a hash stands for them.

1. Anchors of all texts are joined on their hash. Where an anchor always has the same extension, all runs but
   the earliest are repeats as a whole, and the earliest stays. No pairs are made: each run meets the earliest.
2. Where an anchor has several extensions (the rims of a repeat), the windows of these runs are compared one by
   one, again each with the earliest of its equals.

Neighbouring repeated windows of a text join to maximal repeats; every word in one is removed. Before each shuffle the
copies inside a task's share are settled there, and one row per hash leaves, so a passage that a third of all
texts share sends a row per share and not per text. Hashes are 64 bits for anchors and another 64 for what surrounds
them, 128 for windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaycast.llm.text import U, Spans, Words, flat, gram_hash, mix, pack, slices, small, text_slices, trimmed, unpack
from assaycast.sources.tables import cut_lineage

LENGTH, SEED = 20, 8
ANCHOR_BASE, CONTEXT_BASE, WINDOW_BASE, SECOND_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3
#: Anchors that a task settles at a time.
HELD = 1_500_000
REPEAT, OPEN, SINGLE, SEVERAL = 2, 3, 0, 1
NO_ID = -(1 << 63)


def winnow(words: Words, length: int, seed: int):
    """Runs of windows with one anchor: first and last window start, anchor hash, and the hash of the extension."""
    x = words.hashes()
    grams = mix(gram_hash(x, seed, ANCHOR_BASE))
    starts = np.flatnonzero(words.left() >= length)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U), none.astype(U)

    def lesser(a, b):  # the later one of equals
        return np.where(grams[b] <= grams[a], b, a)

    best, width, want = np.arange(len(grams)), 1, length - seed + 1
    while 2 * width <= want:
        best, width = lesser(best[:-width], best[width:]), 2 * width
    if width < want:
        best = lesser(best[: len(best) - (want - width)], best[want - width :])
    anchor = best[starts]
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last, anchor = starts[cut], starts[np.append(cut[1:], len(starts)) - 1], anchor[cut]
    around = mix(Spans(x, CONTEXT_BASE).hash(first, last + length) ^ mix((anchor - first).astype(U) + U(1)))
    return first, last, grams[anchor], around


def _earlier(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in ``order``: whether the row before has the same keys."""
    same = np.ones(len(order), bool)
    for k in keys:
        k = k[order]
        same &= np.concatenate([[False], k[1:] == k[:-1]])
    return same


def settle(doc, loc, count, anchor, around):
    """One share of runs: (key, around, doc, loc, count, kind) rows.

    Later copies of a run are repeats; an anchor with several extensions leaves its runs open and sends one mark.
    """
    order = np.lexsort((loc, doc, around, anchor))
    copy = _earlier(order, anchor, around)
    # the first of a class and rows at its very place (a text that comes twice under one id) are no repeats
    head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(order))))
    same_place = (doc[order] == doc[order[head]]) & (loc[order] == loc[order[head]])
    repeat = copy & ~same_place
    anchors = anchor[order]
    group = np.cumsum(~_earlier(order, anchor)) - 1
    classes = np.bincount(group, weights=~copy) if len(group) else np.zeros(0)
    several = classes[group] > 1
    kind = np.where(repeat, REPEAT, np.where(several, OPEN, SINGLE))
    sent = (kind != SINGLE) | ~copy
    lone = mix(doc[order].astype(U) ^ mix(loc[order].astype(U)))  # settled rows spread evenly
    key = np.where(kind == SINGLE, anchors, lone)
    rows = [key, around[order], doc[order], loc[order], count[order], kind]
    rows = _merge([r[sent] for r in rows])
    marks = np.unique(anchors[several])
    zero = np.zeros(len(marks), np.int64)
    return [np.concatenate(p) for p in zip(rows, [marks, zero.astype(U), zero, zero, zero, zero + SEVERAL])]


def _merge(rows):
    """Settled runs that follow each other in a text become one."""
    key, around, doc, loc, count, kind = rows
    done = kind >= REPEAT
    o = np.flatnonzero(done)
    o = o[np.lexsort((loc[o], doc[o], kind[o]))]
    follow = _earlier(o, doc, kind)
    if len(o):
        follow[1:] &= loc[o][1:] == loc[o][:-1] + count[o][:-1]
    heads = np.flatnonzero(~follow)
    total = np.add.reduceat(count[o], heads) if len(heads) else count[o]
    o = o[heads]
    rest = ~done
    return [np.concatenate([r[rest], r[o]]) for r in (key, around, doc, loc)] + [np.concatenate([count[rest], total]), np.concatenate([kind[rest], kind[o]])]


def _places(ids: pa.Array, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document number and place of word positions: the low half counts words, the high half tells texts of one id apart."""
    docs = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    text = np.searchsorted(words.first, at, side="right") - 1
    return docs[text], (text_tags(words)[text] << 32) + at - words.first[text]


def text_tags(words: Words) -> np.ndarray:
    """31 bits of each text's hash."""
    return (words.bytes.hash(words.off[:-1], words.off[1:]) >> U(33)).astype(np.int64)


_RUNS = ["key", "around", "doc", "loc", "n", "kind"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int8()]


def _batch(rows) -> pa.RecordBatch:
    rows = [r.view(np.int64) if r.dtype == U else r for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(r).cast(t) for r, t in zip(rows, _TYPES)], _RUNS)


def repeated_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Step 1: ``doc, loc, n, kind`` of runs of n windows that are repeats or still open; docs: ``id, text``."""

    def run(batches):
        held, size = [], 0
        for b in batches:
            for i, j, data, off in text_slices(b, "text"):
                w = Words(data, off)
                first, last, anchor, around = winnow(w, length, seed)
                doc, loc = _places(b.column("id").slice(i, j - i), w, first)
                held.append((doc, loc, last - first + 1, anchor, around))
                size += len(first)
                if size >= HELD:
                    yield _batch(settle(*map(np.concatenate, zip(*held))))
                    held, size = [], 0
        if size:
            yield _batch(settle(*map(np.concatenate, zip(*held))))

    runs = docs.mapInArrow(trimmed(run), "key long, around long, doc long, loc long, n int, kind byte")
    w = Window.partitionBy("key")
    place = F.struct("doc", "loc")
    single = F.col("kind") == SINGLE
    met = runs.select(
        "*",
        (F.max(F.when(F.col("kind") <= SEVERAL, F.col("kind"))).over(w) == SEVERAL).alias("several"),
        (F.min(F.when(single, F.col("around"))).over(w) != F.max(F.when(single, F.col("around"))).over(w)).alias("differ"),
        F.min(F.when(single, place)).over(w).alias("earliest"),
    )
    judged = F.when(F.col("kind") >= REPEAT, F.col("kind")).when(
        single & (F.coalesce("several", F.lit(False)) | F.coalesce("differ", F.lit(False))), F.lit(OPEN)
    ).when(single & (place > F.col("earliest")), F.lit(REPEAT))
    return met.select("doc", "loc", "n", judged.cast("int").alias("kind")).where("kind is not null")


def _first_of(doc, loc, a, b):
    """Rows that are the first of their window in a share, and those that repeat one."""
    order = np.lexsort((loc, doc, b, a))
    copy = _earlier(order, a, b)
    head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(order))))
    repeat = copy & ~((doc[order] == doc[order[head]]) & (loc[order] == loc[order[head]]))
    return order[~copy], order[repeat]


def _removed(windows: np.ndarray, length: int) -> np.ndarray:
    """Words that a flagged window covers."""
    at = np.flatnonzero(windows)
    cover = np.zeros(len(windows) + length + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length, -1)
    return np.cumsum(cover)[: len(windows)] > 0


def _results(words: Words, removed: np.ndarray, data: bytes, text_too: bool):
    """n_words, n_removed, kept_sha256 and, if wanted, the text without the removed words."""
    out = []
    sums = np.concatenate([[0], np.cumsum(removed)])
    for k in range(len(words.count)):
        a, z = words.first[k], words.first[k + 1]
        lo, hi = words.off[k], words.off[k + 1]
        gone = int(sums[z] - sums[a])
        if not gone:
            body = data[lo:hi]
            left = body
        else:
            # cut from the first removed word of a run to the next kept word, or to the end of the text
            flags = removed[a:z].astype(np.int8)
            edge = np.flatnonzero(np.diff(flags, prepend=0, append=0))
            keep, at = [], lo
            for s, e in zip(edge[::2], edge[1::2]):
                keep.append(data[at : words.start[a + s]])
                at = words.start[a + e] if a + e < z else hi
            left = b"".join([*keep, data[at:hi]])
        sha = hashlib.sha256(b" ".join(left.split())).hexdigest()
        out.append((int(z - a), gone, sha, left if text_too else None))
    return out


def _runs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row number, loc, n and kind of the runs in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat_runs = column.flatten()
    get = lambda f: flat_runs.field(f).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lengths)), lengths), get("loc"), get("n"), get("kind")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED, keep_text: bool = False,
) -> DataFrame:
    """``row`` (the given row without its text), ``n_words, n_removed, kept_sha256, kept_text`` of every row.

    A word goes if a window of ``length`` words over it starts earlier too: in a smaller id (null is smallest) or
    earlier in the text. Windows are judged on the input. ``kept_text`` (with ``keep_text``) is the text without
    the removed words and the white space after them; the digest is over its words, joined by one space.
    Null and empty texts have no words. Rows of one id with equal texts are one document and get equal results; texts
    of one id that differ are ordered by their hash. An empty table gives no rows.
    """
    if not 1 <= seed <= length:
        raise ValueError("the seed must be 1 to length words")
    other = [f for f in docs.columns if f != text]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in other]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    )
    kind_of_row = rows.schema["row"].dataType.simpleString()
    runs = repeated_runs(rows.select("id", "text"), length, seed)
    per_doc = runs.groupBy("doc", F.shiftright("loc", 32).alias("tag")).agg(F.collect_list(F.struct("loc", "n", "kind")).alias("runs"))

    def pack_rows(batches):
        for b in batches:
            for i, j, data, off in text_slices(b, "text"):
                w, part = Words(data, off), b.slice(i, j - i)
                ids = part.column("id").cast(pa.int64()).fill_null(NO_ID)
                raw = data.tobytes()
                packed = pack([raw[a:z] for a, z in zip(off[:-1], off[1:])])
                yield pa.RecordBatch.from_arrays([part.column("row"), ids, pa.array(text_tags(w)), pa.array(packed, pa.binary())], ["row", "doc", "tag", "packed"])

    packed = rows.mapInArrow(trimmed(pack_rows), f"row {kind_of_row}, doc long, tag long, packed binary")
    met = packed.join(per_doc, ["doc", "tag"], "left").select("row", "doc", "tag", "packed", "runs")
    result = "n_words long, n_removed long, kept_sha256 string, kept_text string"
    names = ["row", "n_words", "n_removed", "kept_sha256", "kept_text", "doc", "tag", "packed", "runs", "window"]
    runs_type = "array<struct<loc:bigint,n:int,kind:int>>"

    def finished(part, words, removed, raw):
        return [list(c) for c in zip(*_results(words, removed, raw, keep_text))] or [[]] * 4

    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    run_arrow = pa.list_(pa.struct([("loc", pa.int64()), ("n", pa.int32()), ("kind", pa.int32())]))
    win_arrow = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("doc", pa.int64()), ("loc", pa.int64())])

    def unfold(part):
        """Slices of a batch of packed rows."""
        texts = pa.array(unpack(part.column("packed").to_pylist()), pa.large_binary())
        for i, j, data, off in slices(*flat(texts)):
            yield part.slice(i, j - i), data, off

    def look(batches):
        """Finish the texts without open runs; of the others keep the text and give out the open windows."""
        for b in batches:
            for part0 in small(b):
                for part, data, off in unfold(part0):
                    w = Words(data, off)
                    row, loc, n, kind = _runs_of(part.column("runs"))
                    open_rows = np.zeros(len(part), bool)
                    open_rows[row[kind == OPEN]] = True
                    flags = np.zeros(len(w.start) + 1, np.int64)
                    done = kind == REPEAT
                    start = w.first[row] + (loc & 0xFFFFFFFF)
                    np.add.at(flags, start[done], 1)
                    np.add.at(flags, start[done] + n[done], -1)
                    removed = _removed(np.cumsum(flags[:-1]) > 0, length)
                    cols = finished(part, w, removed, data.tobytes())
                    closed = np.flatnonzero(~open_rows)
                    if len(closed):
                        size = len(closed)
                        take = pa.array(closed)
                        out = [part.column("row").take(take), *[pa.array(c, t).take(take) for c, t in zip(cols, types)]]
                        none = [pa.nulls(size, t) for t in (pa.int64(), pa.int64(), pa.binary(), run_arrow, win_arrow)]
                        yield pa.RecordBatch.from_arrays([*out, *none], names)
                    wait = np.flatnonzero(open_rows)
                    if not len(wait):
                        continue
                    # the open windows of this slice: first ones go out, copies of them are repeats already
                    k = np.flatnonzero(kind == OPEN)
                    at = np.repeat(start[k], n[k]) + np.arange(n[k].sum()) - np.repeat(np.cumsum(n[k]) - n[k], n[k])
                    at = np.unique(at)
                    x = w.hashes()
                    a, z = mix(gram_hash(x, length, WINDOW_BASE))[at], mix(gram_hash(x, length, SECOND_BASE))[at]
                    doc = part.column("doc").to_numpy(zero_copy_only=False)
                    tag = part.column("tag").to_numpy(zero_copy_only=False)
                    text = np.searchsorted(w.first, at, side="right") - 1
                    place = (tag[text] << 32) + at - w.first[text]
                    first, again = _first_of(doc[text], place, a, z)
                    more: dict[int, list] = {}
                    for i in again:
                        more.setdefault(int(text[i]), []).append({"loc": int(place[i]), "n": 1, "kind": REPEAT})
                    old = [[r for r in rs if r["kind"] == REPEAT] for rs in part.column("runs").take(pa.array(wait)).to_pylist()]
                    take, size = pa.array(wait), len(wait)
                    yield pa.RecordBatch.from_arrays([
                        part.column("row").take(take), *[pa.nulls(size, t) for t in types], *[part.column(c).take(take) for c in ("doc", "tag", "packed")],
                        pa.array([o + more.get(int(i), []) for o, i in zip(old, wait)], run_arrow), pa.nulls(size, win_arrow),
                    ], names)
                    window = pa.StructArray.from_arrays(
                        [pa.array(v.view(np.int64)) for v in (a[first], z[first])] + [pa.array(v[first]) for v in (doc[text], place)], ["a", "b", "doc", "loc"]
                    )
                    size = len(first)
                    none = [pa.nulls(size, t) for t in (part.column("row").type, *types, pa.int64(), pa.int64(), pa.binary(), run_arrow)]
                    yield pa.RecordBatch.from_arrays([*none, window], names)

    schema = f"row {kind_of_row}, {result}, doc long, tag long, packed binary, runs {runs_type}, window struct<a:bigint,b:bigint,doc:bigint,loc:bigint>"
    looked = cut_lineage(met.mapInArrow(trimmed(look), schema), "substring-looked")
    windows = looked.where("window is not null").select("window.*")
    w = Window.partitionBy("a", "b")
    place = F.struct("doc", "loc")
    again = windows.withColumn("earliest", F.min(place).over(w)).where(place > F.col("earliest"))
    late = again.groupBy("doc", F.shiftright("loc", 32).alias("tag")).agg(F.collect_list("loc").alias("late"))
    waiting = looked.where("packed is not null").select("row", "doc", "tag", "packed", "runs").join(late, ["doc", "tag"], "left")

    def finish(batches):
        for b in batches:
            for part0 in small(b):
                for part, data, off in unfold(part0):
                    w = Words(data, off)
                    row, loc, n, _ = _runs_of(part.column("runs"))
                    lists = part.column("late")
                    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    late_row = np.repeat(np.arange(len(part)), lengths)
                    late_loc = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    row, loc, n = np.concatenate([row, late_row]), np.concatenate([loc, late_loc]), np.concatenate([n, np.ones(len(late_loc), np.int64)])
                    flags = np.zeros(len(w.start) + 1, np.int64)
                    start = w.first[row] + (loc & 0xFFFFFFFF)
                    np.add.at(flags, start, 1)
                    np.add.at(flags, start + n, -1)
                    removed = _removed(np.cumsum(flags[:-1]) > 0, length)
                    cols = finished(part, w, removed, data.tobytes())
                    yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(c, t) for c, t in zip(cols, types)]], names[:5])

    last = waiting.mapInArrow(trimmed(finish), f"row {kind_of_row}, {result}")
    return looked.where("n_words is not null").select(*names[:5]).unionByName(last)
