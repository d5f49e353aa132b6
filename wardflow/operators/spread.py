"""Even use of the cores for column work that costs much more than reading."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_files(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer splits than twice the cores.

    A small file is one or two splits, and a long text expression would run there while the other
    cores wait. Such a scan is small: fewer splits than twice the cores, none beyond
    ``spark.sql.files.maxPartitionBytes``. A larger one stays as it is, and its rows where they
    are. Nothing is run to find out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
