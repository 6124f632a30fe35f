"""A training-data pipeline over ``documents``: quality, near-duplicates, repeated passages, mixing, token pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns of ``docs`` as they came, whatever these are;
``doc_id``, ``text``, ``lang`` and ``source`` are read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaycast.llm import catalog, kneser_ney, minhash_dedup, mixing, piece_sampling, substring_dedup
from assaycast.llm.shipping import ship
from assaycast.session import scratch_dir


def _rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), ``id`` and ``hash`` of the text, so that no column of ``docs`` can clash with another."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")
    )


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    ship(spark)
    verdicts = kneser_ney.judge(docs, catalog.table(spark, sf_dir, "labels"))
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash"))
    same = (F.col("hash") == F.col("gone_hash")) & F.col("id").eqNullSafe(F.col("gone"))
    return _rows(docs).join(gone, same, "left_anti").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least id, null after all others; a row that repeats it goes as well."""
    ship(spark)
    classes = minhash_dedup.near_duplicates(docs)
    # not by class_id: unrelated texts with null or repeated ids share it
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("class_id"), F.col("text_hash").alias("class_hash")))
    chosen = classes.groupBy("class_key").agg(least.alias("chosen")).select("chosen.class_id", "chosen.class_hash")
    same = (F.col("hash") == F.col("class_hash")) & F.col("id").eqNullSafe(F.col("class_id"))
    met = _rows(docs).join(chosen, same).select("row", "id", "hash")
    # of equal rows one: they stand together since the join
    copy = F.row_number().over(Window.partitionBy("hash", "id").orderBy("hash"))
    return met.withColumn("copy", copy).where("copy = 1").select("row.*")


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; documents of which nothing is left go.

    ``n_chars``, where there is one, counts the characters of the new text.
    """
    ship(spark)
    kept = substring_dedup.remove_repeats(docs, keep_text=True).where("n_words > n_removed")
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("kept_text").alias(name))
        elif name == "n_chars":
            columns.append(F.length("kept_text").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"row.`{name}`").alias(name))
    return kept.select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents that it does not take go."""
    ship(spark)
    mixed = mixing.mix_sources(docs).where("taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size"), (F.col("taken") / F.col("size")).cast("int").alias("_times")
    )
    # rows of one id and size are taken alike
    times = mixed.groupBy("_id", "_size").agg(F.max("_times").alias("_times"))
    rows = _rows(docs).withColumn("words", mixing.n_words(F.col("row.text")))
    met = rows.join(times, F.col("id").eqNullSafe(F.col("_id")) & (F.col("words") == F.col("_size")))
    return met.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, ids, n_pieces, lossless`` of every row; copies of a document get the same segmentation."""
    ship(spark)
    return piece_sampling.sample_pieces(docs, catalog.tokenizer_file("piece_bpe_32k.model"), keep=["source"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup),
    ("substring dedup", passage_dedup),
    ("source mixing", mix_sources),
    ("piece encoding", encode_pieces),
]

# sampled segmentation, signatures and trained models are not SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again."""
    docs = catalog.table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = os.path.join(path, f"stage-{k}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
