from __future__ import annotations

import numpy as np
import pytest

from assaycast.llm import ann


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q, v in queries:
        v = np.array(v, float)
        s = (x * v).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((v * v).sum()))
        best = {}
        for i, t in zip(ids, s):
            if i != q:
                best[int(i)] = max(best.get(int(i), -2.0), float(t))
        out[q] = sorted(best.items(), key=lambda r: (-round(r[1], 12), r[0]))[:k]
    return out


def rows_of(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.parametrize("spread", [1.0, 0.1])
def test_recall_and_scores(shipped, clash, spread):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 32))
    rows = [(k, (centres[k % 12] * (spread < 1) + spread * rng.standard_normal(32)).tolist()) for k in range(3000)]
    df = clash(shipped.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(5)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = rows_of(ann.nearest(df, df.where("vec_id % 20 = 0")))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    x = dict(rows)
    for q, found in got.items():
        for i, s in found:
            a, b = np.array(x[q]), np.array(x[i])
            assert abs(s - (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) < 1e-12


def test_many_equal_vectors_tie_to_the_smaller_id(shipped, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(3)
    rows = [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 else rng.standard_normal(4).tolist()) for k in range(900)]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = rows_of(ann.nearest(df, df.where("vec_id % 20 = 0")))
    for q in got:
        if q % 3:
            assert [i for i, _ in got[q]] == [k for k in range(20) if k % 3 and k != q][:5]


def test_odd_vectors(shipped):
    rows = [
        (0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, []),
        (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (1, [0.9, 0.1]), (10, [1e200, 1e200]),
    ]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(ann.nearest(df, df))
    assert set(got) == {0, 1, 9, 10}
    assert [i for i, _ in got[0]] == [1, 10, 9]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    one = df.where("vec_id = 0")
    assert ann.nearest(one, one).count() == 0


def test_ids_that_repeat_fill_no_places(shipped):
    rng = np.random.default_rng(4)
    near = [1.0, 0.0, 0.0, 0.0]
    rows = [(0, near)] + [(1, [1.0, 0.001 * j, 0.0, 0.0]) for j in range(8)] + [(k, rng.standard_normal(4).tolist()) for k in range(2, 12)]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = rows_of(ann.nearest(df, df.where("vec_id = 0")))
    want = brute(rows, [rows[0]])
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]] and len(got[0]) == 5


def test_each_id_one_to_twenty_times(shipped):
    rng = np.random.default_rng(6)
    rows = [(k, (rng.standard_normal(8) if j % 3 else np.full(8, 1.0 + k)).tolist()) for k in range(60) for j in range(1 + k % 20)]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = df.where("vec_id % 20 = 0").dropDuplicates(["vec_id"])
    got = rows_of(ann.nearest(df, asked))
    want = brute(rows, [(r["vec_id"], r["embedding"]) for r in asked.collect()])
    for q, found in got.items():
        assert len({i for i, _ in found}) == 5
        assert np.allclose([s for _, s in found], [s for _, s in want[q]], atol=0.2)


def test_large_and_small_components(shipped):
    rows = [(0, [1e200] * 4), (1, [1e200, 1e200, 1e200, 0.0]), (2, [1e-200] * 4), (3, [-1e308] * 4), (4, [1.0, 1.0, 0.0, 0.0])]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(ann.nearest(df, df.where("vec_id = 0")))[0]
    assert [i for i, _ in got] == [2, 1, 4, 3]
    assert np.allclose([s for _, s in got], [1.0, np.sqrt(0.75), np.sqrt(0.5), -1.0])
