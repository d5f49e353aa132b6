"""First n, top k, and top k inside groups, always with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows of a total order: per-partition top n, merged."""
    return df.orderBy(*order_by).limit(n)


def top_k_in_group(df: DataFrame, k: int, group_by: Sequence[str],
                   order_by: Sequence[Column]) -> DataFrame:
    """Best ``k`` rows per group with their rank.

    The filter on the rank becomes a group limit before the shuffle, so at most ``k`` rows
    per group leave each task.
    """
    ranked = Window.partitionBy(*group_by).orderBy(*order_by)
    return (
        df.withColumn("posicao", F.row_number().over(ranked))
        .where(F.col("posicao") <= k)
        .withColumn("posicao", F.col("posicao").cast("long"))
    )
