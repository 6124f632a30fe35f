from __future__ import annotations

import random

import numpy as np
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from assaycast.llm import minhash_dedup as mh
from assaycast.llm.components import components


def jaccard(a, b):
    return len(a & b) / len(a | b)


def sets(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else None


def brute(rows, similarity=0.8):
    own = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and own[j] and jaccard(own[i], own[j]) >= similarity:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))]


def corpus(prose, odd_texts):
    rng = random.Random(8)
    rows = [(k, t) for k, t in enumerate(odd_texts)]
    for base in range(12):
        w = words(prose(base + 70, 120, 3000))
        for copy in range(rng.randrange(1, 9)):
            v = list(w)
            for _ in range(rng.randrange(0, 5)):
                v[rng.randrange(len(v))] = f"edit{rng.random()}"
            rows.append((100 * base + 50 + copy, rng.choice([" ", "\n"]).join(v)))
    rows += [(2000, "one two"), (2001, "one two"), (2002, "one two three"), (None, rows[20][1]), (2003, ""), (2004, rows[21][1] + "\n")]
    # a chain: neighbours are similar, its ends are not
    chain = words(prose(1, 200, 5000))
    rows += [(3000 + k, " ".join(chain[10 * k : 10 * k + 100])) for k in range(10)]
    return rows


@pytest.mark.parametrize("leaders,tile", [(4, 256), (1, 2)])
def test_classes_against_brute_force(shipped, prose, odd_texts, clash, leaders, tile):
    rows = corpus(prose, odd_texts)
    docs = clash(shipped.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    got = mh.near_duplicates(docs, leaders=leaders, tile=tile).collect()
    want = {d: c for (d, _), c in zip(rows, brute(rows))}
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    size = {}
    for c in want.values():
        size[c] = size.get(c, 0) + 1
    assert all(r["class_size"] == size[r["class_id"]] for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[2001]["text_class"] == 2000 and by[2003]["class_id"] == 2003


def test_repeated_rows_and_no_rows(shipped, prose):
    rows = [(1, prose(1, 60)), (1, prose(1, 60)), (1, prose(2, 60)), (2, prose(2, 60) + " x")]
    got = mh.near_duplicates(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4 and {r["class_id"] for r in got} == {1}
    assert mh.near_duplicates(shipped.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_without_ids_meet_their_own_shingles_only(shipped, prose):
    texts = [prose(k, 60, 3000) for k in range(40)]
    rows = [(None, t) for t in texts] + [(None, t + " end") for t in texts] + [(7, texts[0]), (7, texts[1])]
    base = shipped.createDataFrame(rows, "id long, text string").select("id", F.xxhash64("text").alias("text_hash"), "text")
    signed = mh.signatures(base).where("node is not null")
    wanted = signed.select(F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"), "node").distinct()
    found = mh._sets(base, wanted)
    assert found.count() == 80 == signed.select("node").distinct().count()
    got = mh.near_duplicates(base, "id").collect()
    assert len(got) == 82 and len({r["class_key"] for r in got}) == 40


def probability_jaccard(x, y):
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def test_registers_agree_with_the_probability_jaccard_similarity():
    rng = np.random.default_rng(5)
    keys = rng.integers(1, 2**63, 60, dtype=np.uint64)
    x = {int(k): float(rng.uniform(1, 4)) for k in keys[:45]}
    y = {int(k): float(x.get(int(k), 1.0) * rng.uniform(0.7, 1.3)) for k in keys[10:]}
    m = 6000
    flat = np.array([*x, *y], np.uint64)
    signature = mh.prob_min_hash(flat, np.array([*x.values(), *y.values()]), np.array([len(x), len(y)]), m)
    want = probability_jaccard(x, y)
    assert abs((signature[0] == signature[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m)


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(6)
    keys = [np.unique(rng.integers(1, 2**63, n, dtype=np.uint64)) for n in (1, 3, 50, 700)]
    together = mh.prob_min_hash(np.concatenate(keys), np.ones(sum(map(len, keys))), np.array([len(k) for k in keys]), 168)
    for k, s in zip(keys, together):
        assert (mh.prob_min_hash(k, np.ones(len(k)), np.array([len(k)]), 168)[0] == s).all()


def test_components_of_chains_and_stars(shipped):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(300, 200), (200, 300), (5, 5)]
    got = components(shipped.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 130)}, 300: 200}
    assert components(shipped.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps_of_sets():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 40, 3000, 6000, 2)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets[:3]]
    assert mh.overlaps(sets[:3], sets[2:]).tolist() == want


def test_repeats_in_one_text_do_not_hide_a_pair(shipped, prose):
    # one text of a pair repeats a line of 20 words 100 times; two words of the rest differ
    rows = []
    for k in range(60):
        line, rest = prose(5000 + k, 20, 90000), words(prose(6000 + k, 90, 90000))
        other = [*rest[:30], "edit", *rest[31:60], "edit", *rest[61:]]
        rows += [(2 * k, f"{line}\n{line}\n{' '.join(rest)}"), (2 * k + 1, f"{line}\n" * 100 + " ".join(other))]
    own = [sets(t) for _, t in rows]
    assert all(0.8 <= jaccard(own[2 * k], own[2 * k + 1]) < 0.9 for k in range(60))
    got = mh.near_duplicates(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 120 and all(r["class_id"] == r["doc_id"] // 2 * 2 for r in got)
