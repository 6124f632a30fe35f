from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from assaycast.llm import piece_sampling as ps
from assaycast.llm.catalog import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return ps.lattice(MODEL)


def draw(model, texts, keys=None, seed=0, alpha=1.0):
    ids, n = ps.encode(model, texts, keys or list(range(len(texts))), seed, alpha)
    off = np.concatenate([[0], np.cumsum(n)])
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


def test_decoding_is_lossless_and_rows_do_not_depend_on_their_company(model, odd_texts, prose):
    texts = [t or "" for t in odd_texts] + ["   ", " a  b", "\n \n", "▁▁", "tail "] + [prose(k, 60) for k in range(40)]
    one = draw(model, texts)
    assert [ps.decode(model, i) for i in one] == texts
    keys = list(range(len(texts)))
    assert draw(model, texts[::-1], keys[::-1])[::-1] == one
    assert [draw(model, [t], [k])[0] for k, t in enumerate(texts)] == one
    assert draw(model, texts, seed=1) != one


def segmentations(pieces, text):
    if not text:
        yield (), 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            i, logp = pieces[text[:n]]
            for rest, more in segmentations(pieces, text[n:]):
                yield (i, *rest), logp + more


@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_draws_follow_the_lattice(model, alpha):
    pieces = {model.raw[i].decode(): (int(i), logp) for _, ids, logps in model.tables for i, logp in zip(ids, logps) if i >= 0}
    every = {s: np.exp(alpha * w) for s, w in segmentations(pieces, " there")}
    total, n = sum(every.values()), 20_000
    got = Counter(map(tuple, draw(model, [" there"] * n, alpha=alpha)))
    assert set(got) <= set(every) and len(every) > 20
    for s, w in every.items():
        p = w / total
        assert abs(got[s] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


def test_rows(shipped, odd_texts, clash):
    rows = [(k, t) for k, t in enumerate(odd_texts)] + [(3, "word"), (None, "some words"), (50, "some words")]
    docs = clash(shipped.createDataFrame(rows, "doc_id long, text string"))
    got = ps.sample_pieces(docs.repartition(3), MODEL, keep=["id"]).collect()
    assert len(got) == len(rows) and all(r["lossless"] and r["id"] == "x" and r["n_pieces"] == len(r["ids"]) for r in got)
    again = ps.sample_pieces(docs.coalesce(1), MODEL, keep=["id"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len({str(r["ids"]) for r in got if r["doc_id"] == 3}) == 1
    assert ps.sample_pieces(docs.limit(0), MODEL).count() == 0
