from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_words import WORD, words

from assaycast.llm import quality_rules as qr
from assaycast.llm.text import flat, slices


def brute(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_against_brute_force(odd_texts, prose):
    texts = [*odd_texts, *[prose(k, 120, 30) for k in range(30)], "a\na\n a\na b", "x|y\n" * 50]
    for size in (1, 5_000, 10_000_000):
        parts = [qr.slice_stats(d, o) for _, _, d, o in slices(*flat(pa.array(texts)), size)]
        got = list(zip(*[np.concatenate([p[c] for p in parts]).tolist() for c in BASE]))
        assert got == [brute(t) for t in texts]


def frames(spark, prose, odd_texts):
    rows = [(k, prose(k, 150)) for k in range(400)]
    junk = [(1000 + k, " | ".join(prose(k, 90).split()[:90])) for k in range(30)]
    odd = [(2000 + k, t) for k, t in enumerate(odd_texts)] + [(None, prose(5, 100)), (3000, prose(1, 80)), (3000, prose(1, 80))]
    docs = spark.createDataFrame(rows + junk + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 400, 2)] + [(1000 + k, 0) for k in range(10)], "doc_id long, quality int")
    return docs, labels


def test_forest_catches_junk_and_keeps_prose(shipped, prose, odd_texts, clash):
    docs, labels = frames(shipped, prose, odd_texts)
    got = qr.judge(clash(docs), labels).collect()
    assert len(got) == docs.count()
    kept = {r["doc_id"]: r["kept"] for r in got if r["doc_id"] is not None}
    assert sum(kept[k] for k in range(400)) >= 396
    assert not any(kept[1000 + k] for k in range(30))
    for r in got:
        t = [x for x in docs.where(docs.doc_id.eqNullSafe(r["doc_id"])).limit(1).collect()] if r["doc_id"] in (2005, 3000) else None
        n, _, _, _, rep = (r[c] for c in BASE)
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert not (r["kept"] and r["base_failed"])
        assert t is None or brute(t[0]["text"]) == tuple(r[c] for c in BASE)


def test_same_verdicts_in_any_partitioning(shipped, prose, odd_texts):
    docs, labels = frames(shipped, prose, odd_texts)
    rows = lambda n: sorted(map(str, qr.judge(docs.repartition(n), labels).collect()))
    assert rows(1) == rows(7)


def test_no_labels_and_no_rows(shipped, prose, odd_texts):
    docs, labels = frames(shipped, prose, odd_texts)
    got = qr.judge(docs, labels.limit(0)).collect()
    assert all(r["score"] is None and r["kept"] != r["base_failed"] for r in got)
    assert qr.judge(docs.limit(0), labels).count() == 0


def test_path_lengths_of_a_tree():
    x = np.array([[0.0], [1.0], [2.0], [3.0]])
    nodes = qr.grow(1, x, 30, np.array([0.0]), np.array([10.0]))
    import pandas as pd

    forest = qr.Forest(pd.DataFrame(nodes, columns=[c.split()[0] for c in qr.NODES.split(", ")]), 4)
    s = forest.score(np.array([[9.5], [1.0]]))
    assert s[0] > s[1]
