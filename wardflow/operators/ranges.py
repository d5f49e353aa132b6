"""Range joins as equality joins, and weighted assignment on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import spread
from wardflow.operators.index import running_sum

_GROWTH = 8
# The last level whose width fits 64 bits. The whole range of a long has 16 cells of it.
_TOP = 20


def _level(length: Column) -> Column:
    """Smallest n with 8**n >= length, at most the top level. Whole-number steps, so no
    logarithm rounding."""
    chain = F.when(length <= 1, 0)
    for n in range(1, _TOP):
        chain = chain.when(length <= F.lit(_GROWTH ** n).cast("long"), n)
    return chain.otherwise(_TOP)


def _width(level: Column) -> Column:
    """8**level."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level * 3)


def range_join(points: DataFrame, value: str, intervals: DataFrame, lower: str,
               upper: str) -> DataFrame:
    """Inner join on ``lower <= value < upper`` for whole numbers.

    An interval goes to the level whose cell width (a power of 8) is just large enough, so
    it touches at most two cells there, however long it is; only intervals beyond the top
    level's width touch more, and then at most 17. A point looks into one cell per level in
    use. The join is on (level, cell), with the exact test as residual: no nested loop, and
    no long interval is cut into many pieces. Bounds may span the whole range of a long.
    """
    low, high = F.col(lower).cast("long"), F.col(upper).cast("long")
    # A length can exceed a long, so it is taken in decimals.
    length = high.cast("decimal(20,0)") - low.cast("decimal(20,0)")
    levelled = intervals.where(high > low).withColumn("__level", _level(length))
    # At most 21 values, whatever the data: the levels that occur.
    in_use = sorted(r[0] for r in levelled.select("__level").distinct().collect())
    width = _width(F.col("__level"))
    touched = F.sequence(_cell(low, width), _cell(high - 1, width))
    cells = levelled.withColumn("__cell", F.explode(touched))
    probes = points.withColumn(
        "__probe_level", F.explode(F.array(*[F.lit(n) for n in in_use]) if in_use
                                   else F.array().cast("array<int>"))
    ).withColumn("__probe_cell", _cell(F.col(value), _width(F.col("__probe_level"))))
    hit = (
        (F.col("__probe_level") == F.col("__level"))
        & (F.col("__probe_cell") == F.col("__cell"))
        & (F.col(value) >= F.col(lower))
        & (F.col(value) < F.col(upper))
    )
    return probes.join(cells, hit).drop("__probe_level", "__probe_cell", "__level", "__cell")


def _cell(value: Column, width: Column) -> Column:
    """Floor of value / width in whole numbers, also below zero."""
    whole = value.cast("long")
    return F.call_function("div", whole - F.pmod(whole, width), width)


def weighted_assign(df: DataFrame, key: Column, multiplier: int, weights: DataFrame, weight: str,
                    order_by: list[str]) -> DataFrame:
    """Give each row one weighted entry, in proportion to the weights.

    The entries share the numbers 0..total-1 by running sum; a row draws
    ``pmod(key * multiplier, total)`` and gets the entry whose part contains the draw.
    """
    total = weights.agg(F.sum(F.col(weight).cast("long"))).first()[0]
    if not total:
        raise ValueError("the weights must sum to a positive number")
    bounds = running_sum(weights, weight, order_by)
    drawn = df.withColumn("sorteio", spread(key, multiplier, int(total)))
    return range_join(drawn, "sorteio", bounds, "limite_inf", "limite_sup")
