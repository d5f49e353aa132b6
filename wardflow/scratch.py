"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A table written there outlives the executors that wrote it, so it cuts the lineage of
steps that must not be computed twice (a range partitioning samples its input and may
split it differently the next time).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder. Only a local session may fall back to a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="wardflow-")
    return _own_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet, grouped by application for later clean-up."""
    app = spark.sparkContext.applicationId
    return f"{root(spark)}/wardflow/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Remove everything this application has written here. Results that still read from it
    cannot be used any more; the databases of ``tables.create_layers`` are dropped by
    ``tables.drop_layers`` before."""
    app = spark.sparkContext.applicationId
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root(spark)}/wardflow/{app}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
