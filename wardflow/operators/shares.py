"""Counts per label with their share of the whole or of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.columns import share


def label_shares(df: DataFrame, labels: Sequence[str], within: Sequence[str] = (),
                 count: str = "total", percent: str = "percentual", n: str | None = None) -> DataFrame:
    """Rows per label and their percentage inside ``within`` (or of all rows). ``n``: a column
    with the number of rows that a row of reduced data stands for.

    The window runs over the counts, one row per label, not over the data.
    """
    rows = F.sum(n) if n else F.count("*")
    counts = df.groupBy(*within, *labels).agg(rows.alias(count))
    whole = F.sum(count).over(Window.partitionBy(*within))
    return counts.withColumn(percent, share(F.col(count), whole))


def net_score(labelled: DataFrame, label: str) -> DataFrame:
    """One row: percentage positive minus percentage negative."""
    rows = F.count(label)
    positive = share(F.count_if(F.col(label) == "positive"), rows)
    negative = share(F.count_if(F.col(label) == "negative"), rows)
    return labelled.agg(rows.alias("total"), (positive - negative).alias("saldo"))
