"""Compare a registered query with its SQL on DuckDB: names, types by family, rows as bags."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        path = os.path.join(sf, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (bool, str)):
        return v
    if isinstance(v, (int, float)):
        return repr(float(v)) if isinstance(v, float) else v
    if isinstance(v, Decimal):
        return ("decimal", v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str, limit: int = 3) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    right = bag(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    left = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if left != right:
        out.append(f"rows {sum(left.values())} against {sum(right.values())}, order {sorted(names)}")
        out += [f"only here: {k}" for k in list((left - right))[:limit]]
        out += [f"only SQL:  {k}" for k in list((right - left))[:limit]]
    return out
