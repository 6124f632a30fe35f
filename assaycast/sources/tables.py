"""Tables by path or by catalog name: read, overwrite, append by batch, upsert."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaycast.config import Config
from assaycast.session import scratch_dir


def literal_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    return spark.createDataFrame(list(rows), columns)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """The same rows from a written table in the shared checkpoint folder."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(os.path.join(path, "data"))
    return df.sparkSession.read.parquet(os.path.join(path, "data"))


class Tables:
    """One place that knows where a table of a layer lives.

    With ``catalog.name`` set a table is ``catalog.schema.name``; otherwise a Parquet folder.
    """

    def __init__(self, spark: SparkSession, cfg: Config):
        self.spark, self.cfg = spark, cfg

    def ref(self, layer: str, name: str) -> str:
        cat = self.cfg.catalog
        if cat.name:
            return f"{cat.name}.{getattr(cat, f'schema_{layer}')}.{name}"
        base = getattr(self.cfg.paths, layer) or os.path.join(self.cfg.paths.warehouse_root or "", layer)
        return os.path.join(base, name)

    @property
    def by_name(self) -> bool:
        return bool(self.cfg.catalog.name)

    def exists(self, layer: str, name: str) -> bool:
        ref = self.ref(layer, name)
        if self.by_name:
            return self.spark.catalog.tableExists(ref)
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(ref)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def read(self, layer: str, name: str) -> DataFrame:
        ref = self.ref(layer, name)
        return self.spark.table(ref) if self.by_name else self.spark.read.parquet(ref)

    def overwrite(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the table. ``df`` must not read the table itself."""
        w = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
        ref = self.ref(layer, name)
        w.saveAsTable(ref) if self.by_name else w.parquet(ref)

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        w = df.write.mode("append")
        ref = self.ref(layer, name)
        w.saveAsTable(ref) if self.by_name else w.parquet(ref)

    def replace_partitions(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str]) -> None:
        """Append by partition; partitions that are loaded again are replaced, others untouched."""
        ref = self.ref(layer, name)
        w = df.write.mode("overwrite").partitionBy(*partition_by)
        if not self.by_name:
            w.option("partitionOverwriteMode", "dynamic").parquet(ref)
        elif not self.spark.catalog.tableExists(ref):
            w.saveAsTable(ref)
        else:
            # saveAsTable would replace the whole table; only the session setting makes this overwrite dynamic
            key = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, "dynamic")
            try:
                df.select(*self.spark.table(ref).columns).write.insertInto(ref, overwrite=True)
            finally:
                self.spark.conf.set(key, before)

    def upsert(
        self, df: DataFrame, layer: str, name: str, keys: Sequence[str], partition_by: Sequence[str] = ()
    ) -> None:
        """Insert or update by natural key; running it again changes nothing.

        With ``partition_by`` only the partitions present in ``df`` are read and rewritten. Partition
        columns must follow from the keys, so that a row cannot move between partitions. The source is
        written once before it is compared and merged, so a costly plan runs once.
        """
        keys, parts = list(keys), list(partition_by)
        if not self.exists(layer, name):
            self.overwrite(df, layer, name, parts)
            return
        new = cut_lineage(df, name)
        old = self.read(layer, name).select(*new.columns)
        if parts:
            touched = new.select(*parts).distinct()
            merged = merge_rows(old.join(touched, parts, "left_semi"), new, keys)
            # a named table cannot be read and overwritten in one statement
            self.replace_partitions(cut_lineage(merged, name) if self.by_name else merged, layer, name, parts)
        else:
            self.overwrite(cut_lineage(merge_rows(old, new, keys), name), layer, name)

    def as_of_batch(self, layer: str, name: str, batch_id: str) -> DataFrame:
        """Rows of one batch; the batch is a partition, so no other file is read."""
        return self.read(layer, name).where(F.col("_batch_id") == batch_id)


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a source row of the same key, plus the source rows."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def month_of(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyyMM").cast("int")
