"""Raw plant files: text columns, load metadata, row numbers in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaycast.config import RAGGED, RAW_HEADER
from assaycast.operators.quality import check_contract

META = ["_source_file", "_ingested_at", "_row_number", "_batch_id"]


def read_raw(spark: SparkSession, path: str, required: list[str] | None = None, ragged: str | None = None) -> DataFrame:
    """CSV with every column as text. Each file's header is checked against the contract (DQ01).

    Types are never inferred; only the header line is read ahead. ``_metadata`` stays available.
    The column ``ragged``, if named, has the full text of a line with more or fewer fields than the header, else null.
    """
    header = spark.read.option("header", True).csv(path).columns
    check_contract(header, required or RAW_HEADER)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if ragged:
        schema, reader = schema.add(ragged, T.StringType()), reader.option("columnNameOfCorruptRecord", ragged)
    return reader.schema(schema).csv(path)


def with_load_metadata(df: DataFrame) -> DataFrame:
    """Add source file, load time and batch id; for a frame that comes straight from a file scan.

    The batch id is a hash of path, size and modification time, so the same file is the same batch.
    """
    meta = F.col("_metadata")
    identity = F.concat_ws(
        "|",
        meta["file_path"],
        meta["file_size"].cast("string"),
        F.unix_micros(meta["file_modification_time"]).cast("string"),
    )
    return df.select(
        "*",
        meta["file_path"].alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        F.sha2(identity, 256).alias("_batch_id"),
        meta["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def with_row_number(df: DataFrame) -> DataFrame:
    """Dense number from 1 in file order, per file, without moving a row.

    Rows of one file block are consecutive in one task, so their ids differ by one; the first id of
    each block and the sizes of the blocks before it give the number. Only one small row per block is
    shuffled; it is broadcast only if Spark finds it below its size limit.
    """
    blocks = df.groupBy("_source_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_source_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    out = df.join(starts, ["_source_file", "_block"])
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return out.withColumn("_row_number", number).drop("_block", "_at", "_first", "_before")


def bronze_rows(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    return with_row_number(with_load_metadata(read_raw(spark, path, required, RAGGED)))
