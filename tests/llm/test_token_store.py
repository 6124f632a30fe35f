from __future__ import annotations

import re
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from assaycast.llm import token_store as ts
from assaycast.llm.catalog import tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "  a  b", "x \n y", "foo   bar\n\n baz ", "a <|endoftext|> b", "it's  don't\nwe'll", "a\t b", " lead", "é è  ", "　 x",
    "a\nb\n", "\n", "\nab", "x<|endoftext|>y z", "tab\tin word", "a b c d",
]


@pytest.mark.parametrize("layout", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000])
def test_planes_go_back(layout, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    planes = ts.to_planes(ids, layout)
    assert len(planes) == {"byte": 4, "bit": 32}[layout]
    assert (ts.from_planes(planes, n, layout) == ids).all()


@pytest.mark.parametrize("cache", [700_000, 30])
def test_units_encode_as_whole_texts(prose, odd_texts, monkeypatch, cache):
    monkeypatch.setattr(ts, "CACHE_UNITS", cache)
    plain, fast = Tokenizer.from_file(FILE), ts.Encoder(FILE)
    texts = ODD + [t or "" for t in odd_texts] + [prose(k, 80).replace(" b", ", B") for k in range(40)]
    assert fast.splits
    for i in range(0, len(texts), 7):
        ids, n = fast.encode(texts[i : i + 7], 0)
        want = [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts[i : i + 7]]
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


def test_white_space_is_found_as_the_pattern_finds_it():
    fast = ts.Encoder(FILE)
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if re.match(r"\s", chr(c))]
    assert sorted(spaces) == sorted([*fast.RARE, " ", "\n"])
    texts = ["", "a", "a b", "é ü\n漢"] + [t for c in spaces for t in (c, f"a{c}", f"{c}a", f"a{c}b", f"a {c}b", f"a{c} b", f"a{c}{c}b", f"a{c}\nb", f"a\n{c}b", f"é{c}b c")]
    assert all(fast.falls_apart(t) == (not fast.UNSAFE.search(t)) for t in texts)


def test_first_units_are_encoded_once_and_forgotten(monkeypatch):
    monkeypatch.setattr(ts, "HEADS", 3)
    plain, fast = Tokenizer.from_file(FILE), ts.Encoder(FILE)
    calls, whole = [], fast.whole
    monkeypatch.setattr(fast, "whole", lambda t: calls.append(t) or whole(t))
    texts = ["First word", "First one", "Second one", "First", "x" * 101, "x" * 101, "Third a", "Fourth b", "First word"]
    ids, n = fast.encode(texts, 0)
    assert ids.tolist() == sum((plain.encode(t, add_special_tokens=False).ids + [0] for t in texts), [])
    assert calls.count("Second") == 1 and calls.count("x" * 101) == 2 and calls.count("First") == 2 and len(fast.heads) <= 3


def test_units_in_rows_of_any_length_encode_alike(prose, monkeypatch):
    plain, texts = Tokenizer.from_file(FILE), [prose(k, 80).replace(" c", "\nc") for k in range(20)]
    want = sum((plain.encode(t, add_special_tokens=False).ids + [0] for t in texts), [])
    for rows in (1, 3, 1_000_000):
        monkeypatch.setattr(ts, "ROW_UNITS", rows)
        assert ts.Encoder(FILE).encode(texts, 0)[0].tolist() == want


@pytest.mark.parametrize("layout,block", [("byte", 65_536), ("bit", 50)])
def test_store_round_trip(shipped, tmp_path, odd_texts, prose, clash, layout, block):
    texts = ODD + odd_texts + [prose(k, 100) for k in range(60)]
    rows = [(7 * k % 101 - 20, t) for k, t in enumerate(texts)] + [(5, "same"), (5, "same"), (None, "no id")]
    docs = clash(shipped.createDataFrame(rows, "doc_id long, text string")).repartition(5)
    ts.write_tokens(docs, str(tmp_path / "t"), FILE, layout=layout, block=block)
    got = ts.read_tokens(shipped, str(tmp_path / "t")).orderBy("start").collect()
    plain = Tokenizer.from_file(FILE)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    start = 0
    want = {}
    for d, t in rows:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        want.setdefault(d, []).append(ids)
    for r in got:
        assert r["start"] == start and bytes(r["ids"]) in want[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) // 4
        want[r["doc_id"]].remove(bytes(r["ids"]))
        start += r["n_tokens"]
    assert not any(want.values())
    chunks = shipped.read.parquet(str(tmp_path / "t" / "chunks")).collect()
    by = {}
    for c in sorted(chunks, key=lambda c: (c["shard"], c["chunk"])):
        assert c["first_id"] == by.get(c["shard"], 0)
        by[c["shard"]] = c["first_id"] + c["n_ids"]
        assert c["n_ids"] <= block
    assert zlib.crc32(b"") == 0


def test_no_rows(shipped, tmp_path):
    ts.write_tokens(shipped.createDataFrame([], "doc_id long, text string"), str(tmp_path / "t"), FILE)
    assert ts.read_tokens(shipped, str(tmp_path / "t")).count() == 0
