"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning does three things the plans count on: it turns a join into a
# broadcast join once the real size of a side is known, it splits a skewed join
# partition over several tasks, and it merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where a grouping on the join key follows and the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task of a join or grouping holds hash tables and sort buffers of several times what it reads.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows have whole texts: ten thousand of them at a time are too much for a small Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """The same settings for a session that was made elsewhere; all can be set while it runs."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "wardflow", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
