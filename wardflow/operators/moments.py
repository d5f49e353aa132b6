"""Means, deviations and correlations from stored partial rows.

A partial row has a group's n, means, sums of squared deviations and of their products. Rows of
finer groups merge into those of coarser ones: the deviations of the finer means from the coarser
one are added. Nothing is subtracted but means, so large values with small deviations keep their
digits, which sums of squares would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import scratch

PARTS = ["n", "media_x", "media_y", "m2_x", "m2_y", "c"]


def partial_moments(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """One row per group: ``keys`` and ``PARTS``. Rows with a NULL in x or y take no part; a group
    without any other row is left out."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    n = F.count(F.lit(1))
    return both.groupBy(*keys).agg(
        n.alias("n"), F.avg(a).alias("media_x"), F.avg(b).alias("media_y"), (F.var_pop(a) * n).alias("m2_x"),
        (F.var_pop(b) * n).alias("m2_y"), (F.covar_pop(a, b) * n).alias("c"))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for coarser groups. NULL keys are groups of their own; without keys one row (none without parts)."""
    if not keys:
        return merged(parts.withColumn("_all", F.lit(0)), ["_all"]).drop("_all")
    rows = scratch.materialise(parts.select(*keys, *PARTS), "moments")
    total = F.sum("n")
    centres = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(
        total.alias("__n"), (F.sum(F.col("n") * F.col("media_x")) / total).alias("__x"),
        (F.sum(F.col("n") * F.col("media_y")) / total).alias("__y"))
    joined = rows.join(centres, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    dx, dy = F.col("media_x") - F.col("__x"), F.col("media_y") - F.col("__y")
    return joined.groupBy(*keys, "__n", "__x", "__y").agg(
        F.sum(F.col("m2_x") + F.col("n") * dx * dx).alias("m2_x"),
        F.sum(F.col("m2_y") + F.col("n") * dy * dy).alias("m2_y"),
        F.sum(F.col("c") + F.col("n") * dx * dy).alias("c")).select(
        *keys, F.col("__n").alias("n"), F.col("__x").alias("media_x"), F.col("__y").alias("media_y"),
        "m2_x", "m2_y", "c")


def correlation() -> Column:
    """Pearson's correlation of a partial row; NULL if x or y is constant."""
    return F.try_divide(F.col("c"), F.sqrt("m2_x") * F.sqrt("m2_y"))


def deviation(m2: str) -> Column:
    """Population deviation of a partial row's ``m2_x`` or ``m2_y``."""
    return F.sqrt(F.col(m2) / F.col("n"))
