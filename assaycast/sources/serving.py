"""Serving export over JDBC and the metrics file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """PostgreSQL upsert of a loaded staging table, by primary key."""
    cols = ", ".join(columns)
    rest = [c for c in columns if c not in keys]
    action = f"DO UPDATE SET {', '.join(f'{c} = EXCLUDED.{c}' for c in rest)}" if rest else "DO NOTHING"
    return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON CONFLICT ({', '.join(keys)}) {action}"


def run_statement(spark: SparkSession, url: str, properties: dict, statement: str) -> None:
    """One statement on the database, through the driver already on Spark's class path."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def export_serving(
    df: DataFrame, url: str, table: str, keys: Sequence[str], properties: dict,
    connections: int = 8, execute: Callable | None = None, load: Callable | None = None,
) -> None:
    """Load a staging table in parallel, then merge it by key in one statement.

    A lost task only repeats its part of the staging load; the target changes once, at the end.
    ``load`` and ``execute`` stand in for the database in tests.
    """
    staging = f"{table}_staging"
    if load is None:
        w = df.coalesce(connections).write.option("truncate", "true").option("batchsize", "10000")
        w.jdbc(url, staging, mode="overwrite", properties=properties)
    else:
        load(df, staging)
    statement = upsert_statement(table, staging, df.columns, keys)
    (execute or (lambda s: run_statement(df.sparkSession, url, properties, s)))(statement)


def write_metrics(df: DataFrame, path: str) -> None:
    """A short table of metrics as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
