import hashlib
from collections import Counter

import sentencepiece
from tokenizers import Tokenizer

from assaycast.llm import alignment
from assaycast.llm.catalog import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def by_hand(texts):
    """The digest of every text, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment._letter_bytes()
    docs, holders = [], Counter()
    for t in texts:
        want = (" " + t).encode() if t else b""
        spans = []
        for side in "ab" if t else "":
            ids = a.encode(" " + t, add_special_tokens=False).ids if side == "a" else b.encode(t)
            at, out = 0, []
            for i in ids:
                piece = a.id_to_token(i) if side == "a" else b.id_to_piece(i)
                raw = bytes(letters[c] for c in piece) if side == "a" else bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
                if want[at : at + len(raw)] != raw:
                    at = -1
                    break
                out.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(out if at == len(want) else None)
        if not t or None in spans:
            docs.append(None)
            continue
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in spans))
        holders.update(set(links))
        docs.append((len(spans[0]), len(spans[1]), links, groups))
    most = Counter()
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = d
            best = sum(holders[p] == most[p[0]] for p in links)
            out.append((n_a, n_b, len(groups), len(links), best, sum(holders[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def special(prose):
    return [
        "<|endoftext|> and <s> </s> <unk>", "two  spaces", " leading", "trailing ", "tab\tand space", "　wide", "naïve façade — “quoted” don't",
        "▁ low line", "漢字かな交じり文 🙂👩‍👧", "a\r\nb\x00c", "﻿mark", "line\n next\nlast", "ﬁ ligature ½", "x" * 400, "<0x41>", *[prose(k, 30) for k in range(5)],
        prose(1, 30),
    ]


def test_digest_equals_brute_force(shipped, clash, prose, odd_texts):
    texts = [t for t in odd_texts if not t or len(t) < 2000] + special(prose)
    want = Counter(zip(map(str, [None, *range(1, len(texts))]), by_hand(texts)))
    df = clash(shipped.createDataFrame([(k or None, t) for k, t in enumerate(texts)], "doc_id long, text string")).repartition(3)
    for chunk in (60, alignment.CHUNK):
        got = [(str(r["doc_id"]), tuple(r)[1:]) for r in alignment.align_documents(df, A, B, chunk=chunk).collect()]
        assert Counter(got) == want


def test_groups_are_written(shipped, tmp_path):
    df = shipped.createDataFrame([(1, "hello there"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in alignment.align_documents(df, A, B, with_groups=str(tmp_path / "g")).collect()}
    groups = {r["doc_id"]: r["groups"] for r in shipped.read.parquet(str(tmp_path / "g")).collect()}
    assert groups[2] == found[2]["groups_sha256"] == ""
    assert hashlib.sha256(groups[1].encode()).hexdigest() == found[1]["groups_sha256"]


def test_no_rows(shipped):
    assert alignment.align_documents(shipped.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_long_text(shipped):
    df = shipped.createDataFrame([(1, "many words " * 30_000), (2, "y" * 20_000)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in alignment.align_documents(df, A, B, chunk=1000).collect()}
    assert rows[1]["n_links"] >= rows[1]["n_groups"] > 50_000
    assert rows[2]["n_a"] > 0
