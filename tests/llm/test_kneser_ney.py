from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaycast.llm import kneser_ney as kn


def padded(text, order):
    return b"\0" * (order - 1) + text.encode()


class Model:
    """Interpolated modified Kneser-Ney by the book, with dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter()
        for t in texts:
            b = padded(t, order)
            top.update(b[i : i + order] for i in range(len(b) - order + 1))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.mass = {}, {}, {}
        for k, c in self.counts.items():
            n = Counter(min(v, 5) for v in c.values())
            self.d[k] = kn.discounts(*[n[i] for i in (1, 2, 3, 4)])
            total, mass = defaultdict(int), defaultdict(float)
            for g, v in c.items():
                total[g[:-1]] += v
                mass[g[:-1]] += self.d[k][min(v, 3) - 1]
            self.total[k], self.mass[k] = total, mass

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / 256
        lower = self.p(g[1:])
        total = self.total[k].get(g[:-1], 0)
        if not total:
            return lower
        c = self.counts[k].get(g, 0)
        return (max(c - self.d[k][min(c, 3) - 1], 0) / total if c else 0.0) + self.mass[k][g[:-1]] / total * lower

    def bits(self, text):
        b = padded(text, self.order)
        v = [-math.log2(self.p(b[i : i + self.order])) for i in range(len(b) - self.order + 1)]
        return sum(v) / len(v) if v else None


def test_discounts():
    assert kn.discounts(0, 5, 1, 1) == (0.5, 1.0, 1.5)
    y = 10 / 20
    assert kn.discounts(10, 5, 2, 1) == (1 - 2 * y * 5 / 10, 2 - 3 * y * 2 / 5, 3 - 4 * y * 1 / 2)
    assert all(0 <= v <= i + 1 for i, v in enumerate(kn.discounts(10, 5, 40, 90)))


@pytest.mark.parametrize("counts", [(10, 5, 40, 90), (10, 5, 2, 40), (10, 5, 40, 1), (3, 1, 1, 9)])
def test_every_discount_is_above_zero(counts):
    assert all(0 < v <= i + 1 for i, v in enumerate(kn.discounts(*counts)))


def test_unseen_grams_have_a_probability_where_few_grams_are_rare(shipped):
    # the estimates for counts of 2 and of 3 and more are negative, and all that follows a Q was counted 4 times
    counts = [1, 1, 2] + [3] * 5 + [4] * 8
    key = lambda g: int.from_bytes(g.encode(), "big")
    seen = [(key(("Q" if n == 4 else "A") + y), n) for y, n in zip("abcdefghijklmnop", counts)]
    wanted = [(key(g),) for g in ["Aa", "Qp", "Qa", "Qz", "zz"]]
    got = kn.probabilities(shipped.createDataFrame(seen, "h long, c long"), shipped.createDataFrame(wanted, "gram long"), 2).collect()
    assert len(got) == 5 and all(r["bits"] is not None and 0 < r["bits"] < 100 for r in got)


def test_grams_start_after_zero_bytes():
    data = np.frombuffer(b"abcd", np.uint8)
    got = [int(g).to_bytes(3, "big") for g in kn.grams(data, np.array([0, 3, 3, 4]), 3)]
    assert got == [b"\0\0a", b"\0ab", b"abc", b"\0\0d"]


def corpus(spark, prose, odd_texts):
    rows = [(k, ["en", "de", None][k % 3], prose(k, 40 + k % 60)) for k in range(240)]
    rows += [(1000 + k, "en", prose(k, 60).upper() + " #%$ " * 20) for k in range(12)]
    rows += [(2000 + k, "fr", t) for k, t in enumerate(odd_texts)] + [(None, "en", prose(3, 50)), (7, "de", prose(7, 47))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 240, 2)] + [(1000 + k, 0) for k in range(6)] + [(4, 0), (6, 1)], "doc_id long, quality int")
    return rows, docs, labels


@pytest.mark.parametrize("order,parts", [(5, 4), (3, 1)])
def test_perplexity_and_verdicts_against_brute_force(shipped, prose, odd_texts, clash, order, parts):
    rows, docs, labels = corpus(shipped, prose, odd_texts)
    got = kn.judge(clash(docs).repartition(parts), labels, order=order).collect()
    trusted = [k for k in range(0, 240, 2) if k != 4]
    fold = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(kn.HELD_OUT))).collect()}
    model = Model([t for d, _, t in rows if d in trusted and fold[d] != 0], order)
    by = {}
    for d, lang, t in rows:
        by.setdefault((d, lang), []).append(t)
    assert len(got) == len(rows)
    for r in got:
        bits = [model.bits(t) if t else None for t in by[r["doc_id"], r["lang"]]]
        assert r["perplexity"] is None and None in bits or any(b and abs(math.log2(r["perplexity"]) - b) < 1e-4 for b in bits)
        assert r["kept"] == (r["score"] is not None and r["score"] <= r["threshold"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[1000 + k] for k in range(12))
    assert sum(kept[k] for k in range(240)) >= 200
    # thresholds: the first bin edge that the share of good labelled texts does not pass, and at least that of 99.5 % of the held-out scores
    marks = {d: int(d in trusted) for d in [*range(0, 240, 2), *range(1000, 1006)]}

    def edge(rated, level):
        bins = sorted(math.ceil(r["score"] * kn.BINS) for r in rated)
        return next(b for k, b in enumerate(bins, 1) if k / len(bins) >= level and (k == len(bins) or bins[k] != b)) / kn.BINS

    rated = [r for r in got if r["score"] is not None]
    for lang in ("en", "de", None, "fr"):
        own = [r for r in rated if r["lang"] == lang]
        labelled = [r for r in own if r["doc_id"] in marks] or [r for r in rated if r["doc_id"] in marks]
        held = [r for r in own if r["doc_id"] in trusted and fold[r["doc_id"]] == 0] or [r for r in rated if r["doc_id"] in trusted and fold[r["doc_id"]] == 0]
        share = sum(marks[r["doc_id"]] for r in labelled) / len(labelled)
        assert {r["threshold"] for r in got if r["lang"] == lang} == {max(edge(held, kn.QUANTILE), edge(own, share))}


def test_good_text_of_another_vocabulary_stays(shipped, prose):
    # unlabelled copies with their words in another order score worse than what the model learned from, and are as good
    rows = [(k, "en", prose(k, 60)) for k in range(200)]
    rows += [(1000 + k, "en", " ".join(reversed(t.split()))) for k, _, t in rows[:200]]
    rows += [(5000 + k, "en", prose(k, 60).upper() + " #%$ " * 20) for k in range(40)]
    docs = shipped.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = shipped.createDataFrame([(k, 1) for k in range(200)] + [(5000 + k, 0) for k in range(20)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in kn.judge(docs, labels).collect()}
    assert sum(kept[1000 + k] for k in range(200)) >= 190
    assert sum(kept[k] for k in range(200)) >= 190
    assert sum(kept[5000 + k] for k in range(40)) <= 8


def test_bad_texts_beyond_their_labelled_share_go(shipped, prose):
    # one labelled text in 101 is bad, but 30 of 130 texts are; a language without bad labels keeps its share
    bad = prose(1, 60).upper() + " #%$ " * 20
    rows = [(k, "en", prose(k, 60)) for k in range(100)] + [(5000 + k, "en", bad) for k in range(30)]
    rows += [(200 + k, "de", prose(200 + k, 60)) for k in range(50)] + [(300 + k, None, prose(300 + k, 60)) for k in range(50)] + [(400, None, bad), (401, None, bad)]
    docs = shipped.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = shipped.createDataFrame([(k, 1) for k in range(400)] + [(5000, 0), (400, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in kn.judge(docs, labels).collect()}
    assert not any(got[5000 + k]["kept"] for k in range(30)) and not got[400]["kept"] and not got[401]["kept"]
    assert sum(got[k]["kept"] for k in range(100)) >= 95 and all(got[200 + k]["kept"] for k in range(50))


def test_cap_is_the_largest_of_the_best_thresholds(shipped):
    scored = [(1, "a", 0.010), (2, "a", 0.020), (3, "a", 0.100), (4, "a", 0.060), (5, "a", 0.200), (6, "b", 0.5), (7, None, 0.5), (8, None, 0.3), (9, "a", None), (10, "c", 0.1), (None, "a", 0.01)]
    held = shipped.createDataFrame([(1,), (2,), (3,), (7,), (9,), (10,)], "doc_id long")
    quality = shipped.createDataFrame([(k, 1) for k in (1, 2, 3, 7, 9, 10)] + [(4, 0), (5, 0), (6, 0), (8, 0)], "doc_id long, q int")
    got = {r["lang"]: r["cap"] for r in kn.caps(shipped.createDataFrame(scored, "doc_id long, lang string, score double"), quality, held).collect()}
    # a: the bad text of 0.06 costs less than the good one of 0.1, and nothing lies between that and 0.2; '': the good text is the highest; b and c: one kind only
    assert got == {"a": 99 / kn.BINS, "": None}


def test_parts_of_a_split_give_the_same_scores(shipped, prose, odd_texts, tmp_path, monkeypatch):
    _, docs, labels = corpus(shipped, prose, odd_texts)
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    stored = shipped.read.parquet(str(tmp_path / "docs"))

    def run():
        return sorted((str(r["doc_id"]), r["text_hash"], r["perplexity"] and round(r["perplexity"], 6), r["kept"]) for r in kn.judge(stored, labels).collect())

    def chunks():
        return stored.select(kn.chunk_of_input(stored, "doc_id", "text")).distinct().count()

    assert chunks() == 1
    whole = run()
    monkeypatch.setattr(kn, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(kn, "HELD_GRAMS", 100)
    assert chunks() > 1
    assert run() == whole


def test_missing_grams_are_an_error():
    keys, values = np.array([2, 5]), np.array([1.0, 2.0])
    assert kn.look_up(keys, values, np.array([5, 2, 5])).tolist() == [2.0, 1.0, 2.0]
    for asked in ([3], [9], [2, 4]):
        with pytest.raises(RuntimeError):
            kn.look_up(keys, values, np.array(asked))
    assert kn.look_up(keys[:0], values[:0], np.zeros(0, np.int64)).tolist() == []
    with pytest.raises(RuntimeError):
        kn.look_up(keys, np.array([1.0, np.nan]), np.array([5]))


def test_no_labels_and_no_rows(shipped, prose, odd_texts):
    _, docs, labels = corpus(shipped, prose, odd_texts)
    got = kn.judge(docs, labels.limit(0)).collect()
    assert all(r["kept"] == (r["n_bytes"] > 0) for r in got)
    assert kn.judge(docs.limit(0), labels).count() == 0


@pytest.fixture
def settings(shipped):
    """Sets values of the session and puts the old ones back."""
    before = {}

    def put(**values):
        for k, v in values.items():
            key = "spark.sql." + k.replace("__", ".")
            before.setdefault(key, shipped.conf.get(key, None))
            shipped.conf.set(key, v)

    yield put
    for key, v in before.items():
        shipped.conf.unset(key) if v is None else shipped.conf.set(key, v)


def test_chunks_are_bounded_by_text_where_the_file_stores_repeats_once(shipped, prose, tmp_path, monkeypatch):
    text = prose(1, 2000)
    rows = [(k, "en", text) for k in range(300)]
    shipped.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    stored = shipped.read.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(kn, "CHUNK_BYTES", 30 * len(text))
    sizes = [r["count"] for r in stored.groupBy(kn.chunk_of_input(stored, "doc_id", "text").alias("chunk")).count().collect()]
    assert 10 <= len(sizes) <= 11 and max(sizes) < 60


def test_texts_and_answers_of_a_chunk_come_in_several_batches(shipped, prose, odd_texts, tmp_path, monkeypatch, settings):
    _, docs, labels = corpus(shipped, prose, odd_texts)
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    stored = shipped.read.parquet(str(tmp_path / "docs"))

    def run():
        return sorted((str(r["doc_id"]), r["text_hash"], r["lang"], r["n_bytes"], r["perplexity"] and round(r["perplexity"], 6), r["kept"]) for r in kn.judge(stored, labels).collect())

    whole = run()
    assert len(whole) == docs.count()
    settings(execution__arrow__maxRecordsPerBatch="50")
    assert run() == whole


def test_scoring_takes_no_chunk_as_one_group(shipped, prose, odd_texts):
    _, docs, labels = corpus(shipped, prose, odd_texts)
    rows = docs.select(F.lit(1).cast("long").alias("chunk"), "doc_id", F.xxhash64("text").alias("text_hash"), "lang", "text")
    asked = kn.requests(rows.select("chunk", "text"), 3)
    scored = kn.scores(rows, asked.select("gram", F.lit(1.0).alias("bits")), asked, 3)
    assert "CoGroups" not in scored._jdf.queryExecution().executedPlan().toString()
    got = scored.collect()
    assert len(got) == docs.count() and all(r["mean_bits"] == (1.0 if r["n_bytes"] else None) for r in got)


def test_input_is_split_alike_when_the_number_of_cores_changes(shipped, prose, odd_texts, tmp_path, monkeypatch, settings):
    _, docs, labels = corpus(shipped, prose, odd_texts)
    docs.where("doc_id < 2000").coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "docs"))
    stored = shipped.read.parquet(str(tmp_path / "docs"))
    settings(files__openCostInBytes="1", leafNodeDefaultParallelism="3")
    count, inside = kn.trusted_counts, []

    def splits():
        return shipped.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions()

    def counted(*args):
        # between the scan that asks and the scan that scores
        inside.append(splits())
        settings(leafNodeDefaultParallelism="7")
        inside.append(splits())
        return count(*args)

    monkeypatch.setattr(kn, "trusted_counts", counted)
    got = kn.judge(stored, labels).collect()
    assert len(got) == stored.count() and inside[0] == inside[1] > 1
    assert shipped.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert splits() != inside[0]
