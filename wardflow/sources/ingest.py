"""Landing directories that grow: each file is read once, and a run is seen whole or not at all.

A store is a folder of runs. A run writes the rows of the files it found new under ``linhas``, then
one ledger row per file under ``registro``. Spark's commit writes the ledger folder's ``_SUCCESS``
last, and with it the run is published: readers look at runs with it only, so what a run that
broke off has left is never seen, and the next run reads its files again.

A file is known by path, size and time. One that has changed is read again, and its earlier rows
are no longer current; one that is gone keeps its rows. The same run twice adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sources import files

FILE, RUN = "_arquivo", "carga"
LEDGER = "arquivo string, bytes long, modificado timestamp, linhas long, rejeitadas long, carga string"
_SORTS = ("dados", "quarentena")


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """arquivo, bytes, modificado, caminho: every file of a landing directory, also those without a
    row (with a header only, say); ``arquivo`` is the name that rows carry, ``caminho`` the path to read.

    Files whose names begin with ``_`` or ``.`` and files of zero bytes are not data. Only the listing
    is read.
    """
    return spark.read.format("binaryFile").load(landing).select(
        F.col("_metadata.file_path").alias("arquivo"), F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"), F.col("path").alias("caminho"))


def runs(spark: SparkSession, root: str) -> list[str]:
    """The published runs, oldest first: those whose ledger is complete."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/registro/*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(s.getPath().getParent().getName().removeprefix(f"{RUN}=") for s in found)


def _stored(spark: SparkSession, root: str, kind: str, schema: T.StructType, wanted: Sequence[str]) -> DataFrame:
    """The rows of some runs as one scan; the run is a partition column."""
    if not wanted:
        return spark.createDataFrame([], schema)
    if len(wanted) == 1:
        # A constant: a table with a folder per run is then written without a sort by run.
        data = T.StructType([f for f in schema if f.name != RUN])
        one = spark.read.schema(data).parquet(f"{root}/{kind}/{RUN}={wanted[0]}")
        return one.withColumn(RUN, F.lit(wanted[0])).select(*schema.names)
    return spark.read.schema(schema).option("basePath", f"{root}/{kind}").parquet(
        *(f"{root}/{kind}/{RUN}={run}" for run in wanted))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per file and published run that has read it."""
    return _stored(spark, root, "registro", T._parse_datatype_string(LEDGER), runs(spark, root))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The ledger's last row of each file."""
    known = ledger(spark, root)
    return known.groupBy("arquivo").agg(F.max_by(F.struct(*known.columns), RUN).alias("_row")).select("_row.*")


def unread(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """The landed files that no published run has read as they are now."""
    return landed(spark, landing).join(latest(spark, root), ["arquivo", "bytes", "modificado"], "left_anti")


def land(spark: SparkSession, landing: str, root: str, schema: T.StructType, required: Sequence[str] = (),
         header: bool = True, free_text: bool = False,
         before_publishing: Callable[[], None] | None = None) -> int:
    """Read the files that are new since the last published run, and publish them; their number.

    Well-formed rows go to ``dados``, malformed ones to ``quarentena`` (see
    :func:`files.split_malformed`). Without a new file there is no run. Files that land while a run
    works are the next one's. One run at a time: two at once would both read what is new.
    """
    # The paths of the files landed since the last run; Spark's own listing holds them as well.
    new = unread(spark, landing, root).collect()
    if not new:
        return 0
    # Names of runs are in the order of their runs.
    run = f"{len(runs(spark, root)):08d}-{uuid.uuid4().hex}"
    rows = files.read_csv_dir(spark, [r.caminho for r in new], schema, free_text=free_text, header=header)
    # Both sorts in one pass over the raw files, into the same files: folders would need every row sorted.
    bad = files.misfits(rows, required)
    marked = rows.select(*schema.names, files.RAW_LINE, F.col("_metadata.file_path").alias(FILE),
                         F.when(bad, _SORTS[1]).otherwise(_SORTS[0]).alias("destino"))
    marked.write.parquet(f"{root}/linhas/{RUN}={run}")
    if before_publishing:
        before_publishing()
    written = _stored(spark, root, "linhas", _row_schema(schema), [run])
    counts = written.groupBy(FILE).agg(
        F.count_if(F.col("destino") == _SORTS[0]).alias("linhas"),
        F.count_if(F.col("destino") == _SORTS[1]).alias("rejeitadas"))
    # Left: a file without a row is known as well.
    found = spark.createDataFrame([r[:3] for r in new], "arquivo string, bytes long, modificado timestamp").join(
        counts.withColumnRenamed(FILE, "arquivo"), "arquivo", "left")
    zero = F.lit(0).cast("long")
    found.withColumns({c: F.coalesce(c, zero) for c in ("linhas", "rejeitadas")}).select(
        "arquivo", "bytes", "modificado", "linhas", "rejeitadas").write.parquet(f"{root}/registro/{RUN}={run}")
    return len(new)


def _row_schema(schema: T.StructType) -> T.StructType:
    text = [T.StructField(c, T.StringType()) for c in (files.RAW_LINE, FILE, RUN, "destino")]
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), *text])


def current(spark: SparkSession, root: str, schema: T.StructType, sort: str = "dados",
            since: str | None = None) -> DataFrame:
    """The current rows of all published runs, with the file and the run that they come from;
    ``sort``: ``dados`` or ``quarentena`` (with the bad line). ``since`` names a run: only rows of the
    runs published after it, for jobs that add to what they have made before.
    """
    published = runs(spark, root)
    wanted = published[published.index(since) + 1:] if since is not None else published
    extra = [files.RAW_LINE] if sort == _SORTS[1] else []
    rows = _stored(spark, root, "linhas", _row_schema(schema), wanted).where(F.col("destino") == sort).select(
        *schema.names, *extra, FILE, RUN)
    if len(published) < 2:
        return rows
    # Files that a later run has read again: few, so most often a broadcast join.
    known = ledger(spark, root).select(F.col("arquivo").alias("_f"), F.col(RUN).alias("_c"))
    newest = known.groupBy("_f").agg(F.max("_c").alias("_last"))
    old = known.join(newest, "_f").where("_c < _last").select("_f", "_c")
    return rows.join(old, (F.col(FILE) == F.col("_f")) & (F.col(RUN) == F.col("_c")), "left_anti")


def reread(spark: SparkSession, root: str, since: str) -> bool:
    """Has a run after ``since`` read a file again that it or an earlier one had read?"""
    known = ledger(spark, root)
    before = known.where(F.col(RUN) <= since).select("arquivo")
    return not known.where(F.col(RUN) > since).join(before, "arquivo", "left_semi").isEmpty()
