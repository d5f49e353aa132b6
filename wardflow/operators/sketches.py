"""A table's profile in one scan, by mergeable sketches.

Each column gets its rows, NULLs, least and greatest value, and sketches: HyperLogLog for distinct
values, KLL for quantiles of numbers. One row per column is all that leaves a task, whatever the
number of values. Profiles of parts of a table (days, files, regions) are stored and merge into
that of the whole without a second look at the rows. The exact form is ``tables.table_profile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12       # 2^12 buckets
HLL_ERROR = 0.05    # relative; three standard errors of that size
KLL_K = 200
KLL_ERROR = 0.0165  # of a rank, in shares of the rows (at 99 %)


def _number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _comparable(column: Column, kind: T.DataType) -> Column:
    """Text that is equal for equal values: one zero, instants instead of local times."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0.0).cast(kind)
    return (F.unix_micros(column) if isinstance(kind, T.TimestampType) else column).cast("string")


def sketch_profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A row per column (and group of ``keys``, the parts that are stored): column_name, n_rows, n_nulls,
    min_value, max_value (text), distintos (HLL), quantis (KLL; NULL for columns that are no numbers).

    NaN is no part of the quantiles. An empty table without keys has a row per column, with NULL
    bounds.
    """
    cells = []
    for field in df.schema:
        if field.name in keys:
            continue
        c, number = F.col(field.name), _number(field.dataType)
        value = c.cast("double")
        quantiles = F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(KLL_K)) if number \
            else F.lit(None).cast("binary")
        cells.append(F.struct(
            F.lit(field.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(c.isNull()).alias("n_nulls"), F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
            F.hll_sketch_agg(_comparable(c, field.dataType), F.lit(HLL_BITS)).alias("distintos"),
            quantiles.alias("quantis"), F.min(value).alias("min_numero") if number else F.lit(None).cast("double").alias("min_numero"),
            F.max(value).alias("max_numero") if number else F.lit(None).cast("double").alias("max_numero")))
    rows = df.groupBy(*keys) if keys else df
    return rows.agg(F.array(*cells).alias("_cells")).select(*keys, F.explode("_cells").alias("_c")).select(
        *keys, "_c.*")


def merge_profiles(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profiles of parts (rows of :func:`sketch_profile`) as one per column and group of ``keys``."""
    number = F.max("max_numero").isNotNull()
    low = F.min_by("min_value", "min_numero"), F.min("min_value")
    high = F.max_by("max_value", "max_numero"), F.max("max_value")
    return parts.groupBy(*keys, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.when(number, low[0]).otherwise(low[1]).alias("min_value"),
        F.when(number, high[0]).otherwise(high[1]).alias("max_value"),
        F.hll_union_agg("distintos").alias("distintos"), F.kll_merge_agg_double("quantis").alias("quantis"),
        F.min("min_numero").alias("min_numero"), F.max("max_numero").alias("max_numero"))


def read_profile(profile: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The profile in figures: n_distinct (within ``HLL_ERROR``) and an array of quantiles (ranks within
    ``KLL_ERROR``; NULL where there is none)."""
    found = F.when(F.col("quantis").isNotNull() & (F.kll_sketch_get_n_double("quantis") > 0),
                   F.array(*[F.kll_sketch_get_quantile_double("quantis", F.lit(q)) for q in quantiles]))
    return profile.withColumns({
        "n_distinct": F.hll_sketch_estimate("distintos"), "quantiles": found}).drop(
        "distintos", "quantis", "min_numero", "max_numero")
