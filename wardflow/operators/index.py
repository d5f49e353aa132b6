"""Row numbers and running sums over a whole table without a one-partition window.

``row_number() OVER (ORDER BY k)`` moves every row to one task. Here the rows are range
partitioned by the key, numbered inside each partition, and shifted by the sizes of the
partitions before. The only data that meets in one place is one row per partition.

The key must be unique: then no range is larger than its share, and the numbering is the
same as the window's. The ranged rows are written once (see ``scratch``), because a second
evaluation of a range partitioning may cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow import scratch

_PART, _POS, _BEFORE = "__part", "__pos", "__before"
# monotonically_increasing_id keeps the row's position in its partition in the low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def _ranged(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    keys = [F.col(c).asc_nulls_first() for c in order_by]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _offsets(per_part: DataFrame, amount: str) -> DataFrame:
    """Sum of ``amount`` over all earlier partitions; as many rows as partitions."""
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(amount).over(earlier), F.lit(0).cast("long"))
    return per_part.select(_PART, before.alias(_BEFORE))


def distributed_index(df: DataFrame, order_by: Sequence[str], name: str = "idx") -> DataFrame:
    """Add a dense 0-based ``name`` in the order of the unique key ``order_by``."""
    numbered = _ranged(df, order_by).withColumns({
        _PART: F.spark_partition_id(),
        _POS: F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
    })
    written = scratch.materialise(numbered, "ranged")
    sizes = written.groupBy(_PART).agg(F.count("*").alias("n"))
    return (
        written.join(F.broadcast(_offsets(sizes, "n")), _PART)
        .withColumn(name, F.col(_POS) + F.col(_BEFORE))
        .drop(_PART, _POS, _BEFORE)
    )


def running_sum(df: DataFrame, value: str, order_by: Sequence[str], upper: str = "limite_sup",
                lower: str = "limite_inf") -> DataFrame:
    """Add the running sum of a whole-number column: ``upper`` with, ``lower`` without the row."""
    parts = scratch.materialise(
        _ranged(df, order_by).withColumn(_PART, F.spark_partition_id()), "ranged")
    inside = (
        Window.partitionBy(_PART)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # A NULL value adds nothing, but its row still carries the sum so far.
    amount = F.coalesce(F.col(value).cast("long"), F.lit(0).cast("long"))
    totals = parts.groupBy(_PART).agg(F.sum(amount).alias("total"))
    return (
        parts.withColumn(_POS, F.sum(amount).over(inside))
        .join(F.broadcast(_offsets(totals, "total")), _PART)
        .withColumn(upper, F.col(_POS) + F.col(_BEFORE))
        .withColumn(lower, F.col(upper) - amount)
        .drop(_PART, _POS, _BEFORE)
    )


def index_in_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str],
                   name: str = "idx", size: str = "qtd") -> DataFrame:
    """Add a 0-based index inside each group and the group's size.

    A window partitioned by the group would sort one hot group in one task. A global index
    in (group, key) order minus the group's first index gives the same number, and the
    one-row-per-group table comes from a partial aggregation. (group, key) must be unique.
    """
    everything = distributed_index(df, [*group_by, *order_by], name="__global")
    renamed = [F.col(c).alias(f"__g_{c}") for c in group_by]
    groups = everything.groupBy(*renamed).agg(
        F.min("__global").alias("__first"), F.count("*").alias(size))
    same = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_by]
    return (
        everything.join(groups, same)
        .withColumn(name, F.col("__global") - F.col("__first"))
        .drop("__global", "__first", *[f"__g_{c}" for c in group_by])
    )
