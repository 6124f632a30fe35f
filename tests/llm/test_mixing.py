from __future__ import annotations

import hashlib
import random

import pytest

from assaycast.llm import mixing as mx


def h(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def brute(rows):
    """rows: (doc_id, words, source)."""
    size = {}
    for _, n, s in rows:
        size[s] = size.get(s, 0) + n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(order)}
    cap = {s: 2.0 * size[s] for s in order}
    total, target, open_ = 1.5 * sum(size.values()), {}, list(order)
    while open_:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > cap[s]]
        for s in over or open_:
            target[s] = cap[s] if over else share * weight[s]
        open_ = [s for s in open_ if s not in target]
    out = {}
    for s in order:
        epochs = int(target[s] // max(size[s], 1))
        budget, upto = target[s] - epochs * max(size[s], 1), 0
        by = {}
        for d, n, t in rows:
            if t == s:
                by[h(d)] = by.get(h(d), 0) + n
        for k in sorted(by):
            nearer = upto <= budget and upto + by[k] - budget < budget - upto
            out[s, k] = epochs + (upto + by[k] <= budget or nearer)
            upto += by[k]
    return size, target, out


def check(got, rows):
    size, target, times = brute(rows)
    want = sorted(((-1 if d is None else d), n, size[s], round(target[s], 6), n * times[s, h(d)]) for d, n, s in rows)
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got) == want
    taken = {}
    for d, n, s in rows:
        taken[s] = taken.get(s, 0) + n * times[s, h(d)]
    largest = max((n for _, n, _ in rows), default=0)
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in taken)


@pytest.mark.parametrize("levels", [(10, 20, 30), (2, 2, 56)])
def test_against_brute_force(shipped, clash, monkeypatch, levels):
    monkeypatch.setattr(mx, "LEVELS", levels)
    rng = random.Random(1)
    rows = [(k, rng.randrange(0, 60), rng.choice(["a"] * 40 + ["b", "c", "é", "Z", None])) for k in range(700)]
    rows += [(5, 9, "a"), (5, 9, "a"), (None, 4, "b"), (None, 4, None), (900, 5000, "a"), (901, 0, "empty"), (902, 7, "")]
    docs = shipped.createDataFrame([(d, " ".join(["w"] * n) if n else None, s) for d, n, s in rows], "doc_id long, text string, source string")
    check(mx.mix_sources(clash(docs).repartition(5)).select("doc_id", "size", "source_size", "target", "taken").collect(), rows)


def test_one_document_one_source_and_none(shipped):
    docs = shipped.createDataFrame([(1, "a b c", None)], "doc_id long, text string, source string")
    check(mx.mix_sources(docs).collect(), [(1, 3, None)])
    assert mx.mix_sources(docs.limit(0)).count() == 0
    blank = shipped.createDataFrame([(1, "", "x"), (2, None, "y")], "doc_id long, text string, source string")
    assert sorted(map(tuple, mx.mix_sources(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
