from __future__ import annotations

import hashlib
import random

import pytest
from conftest_words import words

from assaycast.llm import substring_dedup as sd
from assaycast.llm.text import SLICE_BYTES  # noqa: F401

LOW = -(1 << 63)


def brute(rows, length=20):
    docs = sorted(((LOW if d is None else d, t) for d, t in rows), key=lambda r: r[0])
    seen, out = {}, {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            if seen.setdefault(k, (d, i)) != (d, i):
                gone[i : i + length] = [True] * length
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def corpus(prose, odd_texts):
    rng = random.Random(2)
    shared = [prose(900 + k, 60, 3000) for k in range(4)]
    rows = [(k, t) for k, t in enumerate(odd_texts)]
    for k in range(10, 120):
        own = prose(k, rng.randrange(5, 120), 3000)
        if k % 3 == 0:
            own += " " + rng.choice(shared) + "\n" + prose(k + 5000, 30, 3000)
        if k % 5 == 0:
            w = words(rng.choice(shared))
            cut = rng.randrange(0, 30)
            own = " ".join(w[cut : cut + 35]) + " " + own
        rows.append((k, own))
    rows += [(200 + k, rows[40 + k][1]) for k in range(10)] + [(300 + k, " ".join(rng.choice("ab") for _ in range(70))) for k in range(30)]
    rows += [(None, shared[0]), (400, "again and " * 40), (-5, shared[1])]
    return rows


@pytest.mark.parametrize("held,parts", [(1_500_000, 3), (40, 1), (1, 6)])
def test_against_brute_force(shipped, prose, odd_texts, clash, monkeypatch, held, parts):
    monkeypatch.setattr(sd, "HELD", held)
    rows = corpus(prose, odd_texts)
    docs = shipped.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sd.remove_repeats(clash(docs)).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert {LOW if r[0] is None else r[0]: tuple(r)[1:] for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_other_lengths(shipped, prose, odd_texts):
    rows = corpus(prose, odd_texts)
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    for length, seed in ((5, 2), (12, 12), (33, 4)):
        got = sd.remove_repeats(docs, length=length, seed=seed).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert {LOW if r[0] is None else r[0]: tuple(r)[1:] for r in got} == brute(rows, length)


def test_text_keeps_its_white_space(shipped):
    block = " ".join(f"w{k}" for k in range(25))
    rows = [(1, f"head\n\n{block}\nTail  end"), (2, f"One\ttwo {block}\n\nthree  four\n"), (3, block)]
    got = sd.remove_repeats(shipped.createDataFrame(rows, "doc_id long, text string"), keep_text=True)
    texts = {r[0]: r[1] for r in got.select("row.doc_id", "kept_text").collect()}
    assert texts == {1: rows[0][1], 2: "One\ttwo three  four\n", 3: ""}


def test_repeated_rows_count_once(shipped, prose):
    text = prose(1, 60)
    rows = [(7, text), (7, text), (8, text), (9, prose(2, 40)), (9, prose(3, 40))]
    got = sd.remove_repeats(shipped.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(7, 0), (7, 0), (8, 60), (9, 0), (9, 0)]


def test_no_rows(shipped):
    assert sd.remove_repeats(shipped.createDataFrame([], "doc_id long, text string")).count() == 0
