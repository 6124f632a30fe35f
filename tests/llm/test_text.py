from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from conftest_words import words

from assaycast.llm import text as tx


def test_words_are_those_of_the_pattern(odd_texts, prose):
    texts = [*odd_texts, *[prose(k, 50) for k in range(20)]]
    for size in (1, 300, 10_000_000):
        found = []
        for _, _, data, off in tx.slices(*tx.flat(pa.array(texts)), size):
            w = tx.Words(data, off)
            raw = data.tobytes()
            for k in range(len(w.count)):
                found.append([raw[w.start[i] : w.end[i]].decode() for i in range(w.first[k], w.first[k + 1])])
        assert found == [words(t) for t in texts]


def test_equal_words_have_equal_hashes_and_others_do_not(prose):
    texts = [prose(k, 200) for k in range(10)]
    (_, _, data, off), = tx.slices(*tx.flat(pa.array(texts)))
    every = [x for t in texts for x in words(t)]
    h = tx.Words(data, off).hashes()
    assert len(set(zip(every, h.tolist()))) == len(set(every)) == len(set(h.tolist()))


def test_gram_hash_is_the_polynomial():
    rng = random.Random(3)
    x = np.array([rng.getrandbits(64) for _ in range(40)], np.uint64)
    base = 0x9E6C63D0876A9A35
    for n in (1, 2, 3, 5, 7, 8, 20, 40):
        want = [sum(int(x[i + j]) * pow(base, j, 1 << 64) for j in range(n)) % (1 << 64) for i in range(len(x) - n + 1)]
        assert tx.gram_hash(x, n, base).tolist() == want
    assert len(tx.gram_hash(x, 41, base)) == 0
    spans = tx.Spans(x, base)
    a, b = np.array([0, 5, 30]), np.array([7, 12, 37])
    same = np.concatenate([x[:7], x[:7]])
    assert tx.Spans(same, base).hash(np.array([0]), np.array([7])) == tx.Spans(same, base).hash(np.array([7]), np.array([14]))
    assert len(set(spans.hash(a, b).tolist())) == 3


def test_packing_goes_back(odd_texts):
    raw = [None if t is None else t.encode() for t in odd_texts]
    assert tx.unpack(tx.pack(raw)) == [r or b"" for r in raw]


def test_trimmed_passes_every_batch_and_trims_after_the_last(monkeypatch):
    seen = []
    monkeypatch.setattr(tx, "trim", lambda: seen.append("trim"))

    def double(batches):
        for b in batches:
            seen.append(b)
            yield 2 * b

    assert list(tx.trimmed(double)(iter([1, 2]))) == [2, 4]
    assert seen == [1, 2, "trim"]
    monkeypatch.undo()
    tx.trim()
