"""The pipeline's stages, each against what it should keep of its own input."""

from __future__ import annotations

import corpus_pipeline as cp
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from assaycast.llm import kneser_ney, minhash_dedup, mixing, substring_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(shipped, tmp_path_factory, prose, odd_texts):
    block = prose(999, 60, 3000)
    rows = [(k, prose(k, 60 + k % 40, 3000), ["en", "de"][k % 2], ["a", "b", None][k % 3]) for k in range(150)]
    rows += [(300 + k, rows[k][1] + " tail", "en", "a") for k in range(10)]
    rows += [(400 + k, prose(700 + k, 70, 3000) + "\n" + block, "en", "c") for k in range(8)]
    rows += [(500 + k, "### $$$ %%% " * 40, "en", "a") for k in range(5)]
    rows += [(600 + k, t, "en", "a") for k, t in enumerate(odd_texts)] + [(5, rows[5][1], "de", None), (None, prose(77, 90, 3000), None, None)]
    d = tmp_path_factory.mktemp("sf")
    docs = [(i, t, g, s, len(t or "")) for i, t, g, s in rows]
    shipped.createDataFrame(docs, COLUMNS).write.parquet(f"{d}/documents.parquet")
    shipped.createDataFrame([(k, 1, 0) for k in range(0, 150)] + [(500, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def rows(df):
    return sorted(map(str, df.collect()))


def test_stages(shipped, folder, clash, tmp_path):
    docs = clash(shipped.read.parquet(f"{folder}/documents.parquet"))
    stages = dict(cp.STAGES)

    kept = stages["quality classifier"](shipped, docs, folder)
    verdicts = {(r["doc_id"], r["text_hash"]) for r in kneser_ney.judge(docs, shipped.read.parquet(f"{folder}/labels.parquet")).where("kept").collect()}
    hashed = docs.withColumn("_h", F.xxhash64("text"))
    want = [r for r in hashed.collect() if (r["doc_id"], r["_h"]) in verdicts]
    assert kept.columns == docs.columns
    assert rows(kept.select("doc_id", "text")) == sorted(str(r) for r in shipped.createDataFrame([(r["doc_id"], r["text"]) for r in want], "doc_id long, text string").collect())
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & set(range(150))) >= 145 and not ids & set(range(500, 505))

    single = stages["near dedup"](shipped, docs, folder)
    classes = minhash_dedup.near_duplicates(docs).select("class_id").distinct().count()
    assert single.columns == docs.columns and single.count() == classes
    ids = [r["doc_id"] for r in single.collect()]
    assert not set(ids) & set(range(300, 310)) and ids.count(5) == 1 and set(range(150)) <= set(ids)

    cut = stages["substring dedup"](shipped, docs, folder)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r for r in cut.where("doc_id between 400 and 407").collect()}
    assert len(words(texts[400]["text"])) == 130 and all(len(words(texts[400 + k]["text"])) == 70 for k in range(1, 8))
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    left = {r[0]: r[1] - r[2] for r in substring_dedup.remove_repeats(docs).select("row.doc_id", "n_words", "n_removed").collect()}
    assert {r["doc_id"] for r in cut.collect()} == {d for d, n in left.items() if n}

    mixed = stages["source mixing"](shipped, docs, folder)
    assert mixed.columns == docs.columns
    taken = mixing.mix_sources(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken")).where("taken > 0")
    got = mixed.groupBy("doc_id").agg(F.sum(mixing.n_words("text")).alias("taken"))
    assert rows(got) == rows(taken)

    pieces = stages["piece encoding"](shipped, docs, folder).collect()
    assert len(pieces) == docs.count() and all(r["lossless"] for r in pieces)


def test_run_and_empty_table(shipped, folder, tmp_path):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "near dedup", "substring dedup", "source mixing", "piece encoding"]
    out = cp.run(shipped, folder)
    assert out.count() > 150 and set(out.columns) == {"doc_id", "source", "ids", "n_pieces", "lossless"}
    empty = shipped.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        empty.write.mode("overwrite").parquet(str(tmp_path / "none"))
        assert stage(shipped, shipped.read.parquet(str(tmp_path / "none")), folder).count() == 0


def test_near_dedup_keeps_different_texts_of_one_id(shipped, prose):
    null = [(None, prose(800 + k, 60, 3000)) for k in range(5)] + [(None, ""), (None, " "), (None, None)]
    one = [(7, prose(810 + k, 60, 3000)) for k in range(3)] + [(7, "")]
    copies = [(None, null[0][1]), (None, null[1][1] + " x"), (8, null[2][1]), (9, one[0][1] + " x"), (7, one[1][1])]
    docs = shipped.createDataFrame([(i, t, "en", "a", 0) for i, t in null + one + copies], COLUMNS)
    got = [(r["doc_id"], r["text"]) for r in cp.near_dedup(shipped, docs, "").collect()]
    # of two near-copies with a null id, either may stay
    pair = {null[1], copies[1]}
    assert len(got) == len(set(got)) == 12 and len(pair & set(got)) == 1
    assert set(got) - pair == {*null, *one, (8, null[2][1])} - pair - {null[2]}
    classes = minhash_dedup.near_duplicates(docs)
    assert classes.select("class_key").distinct().count() == 12 and classes.where("class_key is null").isEmpty()
