"""Cyclic lookups: rows pick an entry of a pool by their key, evenly and repeatably."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.functions.columns import spread
from wardflow.operators.index import distributed_index, index_in_group


def cyclic_lookup(df: DataFrame, key: Column, multiplier: int, pool: DataFrame,
                  pool_order: Sequence[str], position: str = "idx") -> DataFrame:
    """Left join each row to pool entry ``pmod(key * multiplier, size of the pool)``.

    The size is read first, so the join is a plain equality on one column of each side.
    """
    indexed = distributed_index(pool, pool_order, name="__entry")
    size = indexed.count()
    if size == 0:
        keyed = df.withColumn(position, F.lit(None).cast("long"))
    else:
        keyed = df.withColumn(position, spread(key, multiplier, size))
    return keyed.join(indexed, keyed[position] == indexed["__entry"], "left").drop("__entry")


def group_cyclic_lookup(df: DataFrame, group: str, key: Column, multiplier: int, pool: DataFrame,
                        pool_group: str, pool_order: Sequence[str],
                        position: str = "idx") -> DataFrame:
    """The same inside a group: position modulo the size of the row's own group.

    Group sizes are joined first, then (group, position) is one equality join. Joining on
    the group alone and testing the position afterwards would build every pair of a group.
    Entries and sizes are stored: they are computed once, and their real sizes decide whether
    the rows are shuffled to meet them.
    """
    entries = scratch.materialise(index_in_group(
        pool.withColumnRenamed(pool_group, "__pool_group"), ["__pool_group"], pool_order,
        name="__entry", size="__size"), "entries")
    sizes = scratch.materialise(
        entries.groupBy(F.col("__pool_group").alias("__size_group"))
        .agg(F.max("__size").alias("__group_size")), "sizes")
    keyed = (
        df.join(sizes, F.col(group) == F.col("__size_group"), "left")
        .withColumn(position, spread(key, multiplier, F.col("__group_size")))
        .drop("__size_group", "__group_size")
    )
    same = (F.col(group) == F.col("__pool_group")) & (F.col(position) == F.col("__entry"))
    return keyed.join(entries.drop("__size"), same, "left").drop("__pool_group", "__entry")


def pool_lookup(df: DataFrame, choice: str, key: Column, multiplier: int, pools: DataFrame,
                pool_name: str, pool_order: Sequence[str], position: str = "idx") -> DataFrame:
    """Each row names its pool: one table of all pools and one join, instead of a guarded
    join per pool and a coalesce over their results."""
    return group_cyclic_lookup(df, choice, key, multiplier, pools, pool_name, pool_order, position)
