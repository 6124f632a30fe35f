import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from assaycast.llm import packing
from assaycast.llm.catalog import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


def encoded(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def check(found, limit):
    """Every sequence is gapless from 0 and within the limit; gives the number of sequences."""
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def fewest(lengths, limit):
    """The least number of bins, by trying all."""
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= limit:
                put(k + 1, bins[:i] + [bins[i] + lengths[k]] + bins[i + 1 :])
        put(k + 1, [*bins, lengths[k]])

    put(0, [])
    return best


def test_bound_never_exceeds_the_fewest():
    rng = random.Random(5)
    tight = 0
    for _ in range(150):
        lengths = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 9))]
        bound = packing.needed(packing.lower_bound(np.bincount(lengths, minlength=21), 20))
        least = fewest(lengths, 20)
        packed = packing.best_fit_decreasing(np.array(lengths), 20)[2]
        assert bound <= least <= packed
        tight += bound == least
    assert tight > 120


@pytest.mark.parametrize("limit", [2048, 64])
def test_pieces_equal_plain_encoding(shipped, clash, prose, odd_texts, limit):
    texts = [*odd_texts, "<|endoftext|> a<|startoftext|>b", "Ünï ÇÉ!? don't 3,5", *[prose(k, 1 + 40 * k) for k in range(12)], prose(1, 41), prose(1, 41)]
    rows = [(None if k == 3 else k, t) for k, t in enumerate(texts)]
    df = clash(shipped.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    found = packing.pack_documents(df, PATH, limit=limit).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    want = []
    for i, t in rows:
        ids = encoded(t)
        for p, s in enumerate(range(0, len(ids), limit)):
            part = ids[s : s + limit]
            want.append((-1 if i is None else i, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert got == sorted(want)
    assert check(found, limit) >= -(-sum(w[3] for w in want) // limit)


def test_rounds_close_the_gaps(shipped):
    rng = random.Random(8)
    # lengths like those of documents: few long, many short
    rows = [(k, k, 0, 0, min(2047, 1 + int(rng.lognormvariate(5, 1.2))), 0) for k in range(4000)] + [(9999, 9999, 0, 0, 2048, 0)]
    pieces = shipped.createDataFrame(rows, packing.PIECES).repartition(3)
    pieces = shipped.createDataFrame(pieces.collect(), pieces.schema)
    many = packing.pack_pieces(pieces, per_part=100, fan=4).collect()
    assert sorted(r["number"] for r in many) == sorted(r[0] for r in rows)
    n = check(many, 2048)
    bound = packing.needed(packing.lower_bound(np.bincount([r[4] for r in rows], minlength=2049)))
    alone = check(packing.pack_pieces(pieces, per_part=100, fan=10**9).collect(), 2048)
    assert bound <= n <= alone and n <= 1.01 * bound + 2


def test_no_rows(shipped):
    assert packing.pack_documents(shipped.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_sequences_and_certificate(shipped, prose):
    df = shipped.createDataFrame([(k, prose(k, 20 + k)) for k in range(20)], "doc_id long, text string")
    pieces = packing.token_pieces(df, PATH, limit=128, with_ids=True)
    pieces = shipped.createDataFrame(pieces.collect(), pieces.schema)
    placed = packing.pack_pieces(pieces, 128)
    used, bound = packing.certificate(placed, 128)
    out = packing.packed_sequences(pieces, placed).collect()
    assert bound <= used == len(out)
    assert sum(r["n_tokens"] for r in out) == sum(len(r["ids"]) // 4 for r in out) == sum(len(encoded(prose(k, 20 + k))) for k in range(20))
