"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return (type(value).__name__, value)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both have the same columns and the same rows, types included."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} / {sorted(names)}"
    order = sorted(names)
    expected = Counter(tuple(_cell(r[names.index(c)]) for c in order) for r in rows)
    found = Counter(tuple(_cell(r[c]) for c in order) for r in spark_df.select(*order).collect())
    if expected == found:
        return None
    return (f"rows {sum(found.values())} / {sum(expected.values())}; only spark "
            f"{list((found - expected).items())[:3]}; only oracle {list((expected - found).items())[:3]}")
