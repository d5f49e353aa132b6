"""Raw CSV directories: typed scan, replacing write, and a profile of their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_LINE = "_linha_invalida"


# Quotes are doubled inside quoted text, blanks at the ends are kept, and "" is not NULL.
_FREE_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


def read_csv_dir(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 free_text: bool = False, header: bool = True) -> DataFrame:
    """Every part file of a directory (or of a list of paths), read with explicit types, by default
    with a header row.

    Nothing is inferred, so there is no extra pass and the types never drift. Every column is
    read as text and cast here; a row with a wrong number of fields, or with text that does not
    cast, keeps its good fields and its raw text in ``_linha_invalida``. That column is made
    from all columns, so what else a query selects cannot change it.
    ``free_text`` allows line breaks inside quoted fields; such a file is read by one task,
    so write it in parts of moderate size (see :func:`write_csv_dir`).
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    options = {**_FREE_TEXT, "multiLine": "true", "lineSep": "\n"} if free_text else {}
    rows = (
        spark.read.options(**options).schema(texts.add(RAW_LINE, T.StringType()))
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        .csv(path)
    )
    # Each text is cast once; the test for a misfit looks at the result. A text is never a misfit as text.
    typed = {f.name: f"__{f.name}" for f in schema if not isinstance(f.dataType, T.StringType)}
    cast = rows.select(
        "*", F.struct(F.col("_metadata.file_path")).alias("_metadata"),
        *[safe_cast(F.col(f.name), f.dataType.simpleString()).alias(typed[f.name]) for f in schema if f.name in typed])
    misfit = F.lit(False)
    for name, value in typed.items():
        misfit = misfit | (F.col(name).isNotNull() & F.col(value).isNull())
    fields = F.to_csv(F.struct(*[F.col(f.name) for f in schema]))
    return cast.select(
        *[F.col(typed.get(f.name, f.name)).alias(f.name) for f in schema],
        F.coalesce(F.col(RAW_LINE), F.when(misfit, fields)).alias(RAW_LINE),
        F.col("_metadata"))


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The same directory with every column as text, for casts by hand."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(path)


def misfits(rows: DataFrame, required: Sequence[str] = ()) -> Column:
    """Is a row of :func:`read_csv_dir` malformed? A NULL in a required column counts as well."""
    bad: Column = F.col(RAW_LINE).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    return bad


def split_malformed(rows: DataFrame, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows and the rest; a NULL in a required column counts as malformed.

    The rest has the text of the bad line where a line did not fit the schema.
    """
    rows = rows.drop("_metadata")
    bad = misfits(rows, required)
    return rows.where(~bad).drop(RAW_LINE), rows.where(bad)


def write_csv_dir(df: DataFrame, path: str, order_by: Sequence[str] = (),
                  free_text: bool = False, rows_per_file: int = 100_000) -> None:
    """Replace a directory by part files with a header.

    With ``order_by`` the files together are in order: ranges over the files, sorted inside.
    Free text goes into files of at most ``rows_per_file`` rows, because a file with line
    breaks inside its fields is read by one task.
    """
    if order_by:
        keys = [F.col(c) for c in order_by]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    options = {**_FREE_TEXT, "maxRecordsPerFile": rows_per_file} if free_text else {}
    df.write.mode("overwrite").options(**options).option("header", True).csv(path)


def safe_cast(column: Column, kind: str) -> Column:
    """Cast text from a file: what does not parse becomes NULL instead of an error."""
    return column.try_cast(kind)


def landing_profile(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows and bytes of every file of a directory, given the scan of it. A file with no row, such as
    one with a header only, has zero rows; files of zero bytes are not listed."""
    listed = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("length").alias("file_size"),
        F.col("_metadata.file_path").alias("path"))
    counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    return listed.join(counts, "path", "left").select(
        "file_name", "file_size", F.coalesce("n", F.lit(0).cast("long")).alias("n_rows"))
