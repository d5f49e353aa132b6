"""Bronze, silver and gold tables: create, append, replace, views.

Tables are parquet. NOT NULL is not enforced by the format, so :func:`create_table` checks
required columns itself while it writes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")
# Table property with the columns that must not be NULL; the format itself keeps no such rule.
REQUIRED = "wardflow.required"


def create_layers(spark: SparkSession, root: str, suffix: str = "") -> dict[str, str]:
    """One database per layer under ``root``; returns layer -> database name."""
    if suffix and not re.fullmatch(r"[a-z0-9_]+", suffix):
        raise ValueError(f"suffix must be lower-case letters, digits, underscores: {suffix!r}")
    names = {}
    for layer in LAYERS:
        name = f"{layer}_{suffix}" if suffix else layer
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}'")
        names[layer] = name
    return names


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order, types and comments of ``schema``; NULL in a required column fails the job."""
    shaped = []
    for field in schema:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            complaint = F.raise_error(F.lit(f"NULL in required column {field.name}"))
            value = F.when(value.isNull(), complaint.cast(field.dataType)).otherwise(value)
        shaped.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*shaped)


def create_table(df: DataFrame, name: str, schema: T.StructType | None = None,
                 bucket_by: tuple[int, Sequence[str]] | None = None,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table from a query.

    ``bucket_by`` stores it bucketed and sorted, so that later joins and aggregations on
    those columns read it without a shuffle. ``partition_by`` gives each value of the columns a
    folder of its own: filters on them read those folders only, and
    :func:`replace_partitions` replaces one without the others.
    """
    writer = (conform(df, schema) if schema else df).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)
    required = ",".join(f.name for f in schema if not f.nullable) if schema else ""
    if required:
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{REQUIRED}' = '{required}')")
    return df.sparkSession.table(name)


def _schema_of(spark: SparkSession, name: str) -> T.StructType:
    """The table's columns, with those that were required when it was created."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    required = properties.get(REQUIRED, "").split(",")
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in required, f.metadata)
                         for f in spark.table(name).schema])


def append_query(df: DataFrame, name: str) -> DataFrame:
    """Append the rows of a query, matched to the table's columns by name. Types are cast and
    required columns checked as when the table was created."""
    spark = df.sparkSession
    conform(df, _schema_of(spark, name)).write.mode("append").insertInto(name)
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str) -> DataFrame:
    """Replace the partitions that occur in ``df``, and only those; the others keep their files.

    Columns are matched by name, types cast and required columns checked as when the table was
    created. Partitions without a row in ``df`` stay as they are.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"  # an option of the writer is not heeded here
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        conform(df, _schema_of(spark, name)).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    return spark.table(name)


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    """A text that belongs to the table, such as the last run that it has."""
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{value}')")


def property_of(spark: SparkSession, name: str, key: str) -> str | None:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(key)


def append_rows(spark: SparkSession, rows: Sequence[tuple], name: str) -> DataFrame:
    """Append literal rows in the table's column order."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in spark.table(name).schema])
    return append_query(spark.createDataFrame(list(rows), nullable), name)


def drop_layers(spark: SparkSession, names: dict[str, str]) -> None:
    """Drop the databases of :func:`create_layers` with all their tables and files."""
    for name in names.values():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register a query under a name; it is evaluated at each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_stored_view(spark: SparkSession, name: str, comment: str, query: str) -> DataFrame:
    """A view in the catalog over stored tables, with a comment."""
    text = comment.replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{text}' AS {query}")
    return spark.table(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("tabela"), "registros")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _counted(value: Column, kind: T.DataType) -> Column:
    """A text that is equal for equal values: one zero, and instants instead of local times."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(kind)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, least and greatest value as text.

    The columns become (column, value) rows that are counted per value first. Equal values
    meet on the map side, so a value that fills a third of the table costs one row per task.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), _counted(F.col(c), kind).alias("value"))
        for c, kind in kinds.items()
    ])
    per_value = (
        df.select(F.explode(cells).alias("cell"))
        .groupBy("cell.column_name", "cell.value")
        .agg(F.count("*").alias("n"))
    )
    counts = per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
    )
    bounds = df.agg(*[
        F.struct(F.lit(c).alias("bound_of"), F.min(c).cast("string").alias("min_value"),
                 F.max(c).cast("string").alias("max_value")).alias(c)
        for c in kinds
    ])
    per_column = bounds.select(F.explode(F.array(*[F.col(c) for c in kinds])).alias("b")).select("b.*")
    return (
        counts.join(F.broadcast(per_column), counts["column_name"] == per_column["bound_of"], "left")
        .drop("bound_of")
    )
