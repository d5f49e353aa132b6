"""Key checks, cleansing with quarantine, and joins on keys that may be missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is present but has no parent."""
    keys = parent.select(F.col(parent_key).alias("__parent")).distinct()
    present = child.where(F.col(child_key).isNotNull())
    return present.join(keys, F.col(child_key) == F.col("__parent"), "left_anti")


def covered(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that have a parent."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return child.join(keys, F.col(child_key) == F.col("__parent"), "left_semi")


def missing(child: DataFrame, child_key: str) -> DataFrame:
    return child.where(F.col(child_key).isNull())


#: Bytes of a dimension that may be sent to every executor.
SENT_BYTES = 64 << 20


def sent_if_small(dim: DataFrame, most: int | None = None) -> DataFrame:
    """The dimension marked for a broadcast, if its measured size is within ``most`` (``SENT_BYTES``):
    the facts then stay where they are. One aggregation over the dimension."""
    wide = (T.StringType, T.BinaryType)
    row = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) for f in dim.schema if isinstance(f.dataType, wide)),
              F.lit(8 * (len(dim.columns) + 2)).cast("long"))
    size = dim.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(dim) if size <= (SENT_BYTES if most is None else most) else dim


def left_join_optional(fact: DataFrame, key: str, dim: DataFrame, dim_key: str,
                       spread_by: Sequence[str]) -> DataFrame:
    """Left join on a key that many rows lack; the dimension's key column is dropped.

    A shuffle join sends all rows with a NULL key to one task. They can never match, so
    they get a second join column taken from their other columns, which spreads them.
    """
    salted = fact.withColumn(
        "__salt", F.when(F.col(key).isNull(), F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long")))
    # Always 0, but not a literal: a literal would be folded into a condition on the other
    # side, and the second column would no longer take part in the partitioning.
    zero = F.pmod(F.xxhash64("__dim_key"), F.lit(1).cast("long"))
    other = dim.withColumnRenamed(dim_key, "__dim_key").withColumn("__dim_salt", zero)
    same = (F.col(key) == F.col("__dim_key")) & (F.col("__salt") == F.col("__dim_salt"))
    return salted.join(other, same, "left").drop("__salt", "__dim_key", "__dim_salt")


def split_rows(df: DataFrame, reasons: Sequence[tuple[str, Column]],
               reason: str = "motivo") -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected rows with the first reason that applies.

    Both come from one column, so together they are always the whole input.
    """
    cause = F.lit(None).cast("string")
    for name, condition in reversed(list(reasons)):
        cause = F.when(condition, name).otherwise(cause)
    marked = df.withColumn(reason, cause)
    return marked.where(F.col(reason).isNull()).drop(reason), marked.where(F.col(reason).isNotNull())


MASK = "_motivos"
DUPLICATE = "duplicate_key"


def mark_rows(df: DataFrame, rules: Sequence[tuple[str, Column]], unique: Sequence[str] = ()) -> DataFrame:
    """The rows with ``_motivos``: a bit for every rule that applies, in their order, and after them one
    for rows whose key ``unique`` another row has too. At most 62 rules.

    A rule whose condition is NULL does not apply. NULL is a key value like any other. Keys that
    occur more than once are found by a partial aggregation and written; most often they are few
    and sent to the rows, which then do not move.
    """
    if len(rules) > 62:
        raise ValueError("a mask has room for 62 rules")
    mask = F.lit(0).cast("long")
    for bit, (_, condition) in enumerate(rules):
        mask = mask + F.when(condition, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
    if not unique:
        return df.withColumn(MASK, mask)
    names = [f"__u{i}" for i in range(len(unique))]
    repeated = scratch.materialise(
        df.groupBy(*(F.col(c).alias(n) for c, n in zip(unique, names, strict=True)))
        .agg(F.count("*").alias("__n")).where("__n > 1"), "repeated-keys")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(unique, names, strict=True)]
    twice = F.when(F.col("__n").isNotNull(), F.lit(1 << len(rules)).cast("long")).otherwise(F.lit(0).cast("long"))
    return df.join(repeated, same, "left").select(*df.columns, (mask + twice).alias(MASK))


def reasons(mask: Column, rules: Sequence[tuple[str, Column]]) -> Column:
    """The names of a mask's reasons, in the rules' order."""
    names = [*(name for name, _ in rules), DUPLICATE]
    held = [F.when(F.getbit(mask, F.lit(bit)) == 1, name) for bit, name in enumerate(names)]
    return F.array_compact(F.array(*held))


def store_checked(df: DataFrame, path: str, rules: Sequence[tuple[str, Column]], unique: Sequence[str] = ()
                  ) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Kept rows, rejected ones with all their reasons (``motivos``), and the counts, from one write.

    The counts (``total`` and every reason's rows) are observed while the rows are written, without a
    second scan. They are taken in the stage that writes, where a task that is run again counts
    once. A row with no reason is kept; no rows give zero counts.
    """
    spark = df.sparkSession
    names = [*(name for name, _ in rules), *([DUPLICATE] if unique else [])]
    seen = Observation(f"checked-{path}")
    marked = mark_rows(df, rules, unique).observe(
        seen, F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.getbit(F.col(MASK), F.lit(bit)) == 1).alias(name) for bit, name in enumerate(names)))
    destination = F.when(F.col(MASK) == 0, "dados").otherwise("quarentena")
    marked.withColumn("destino", destination).write.partitionBy("destino").parquet(path)
    schema = marked.schema.add("destino", "string")
    stored = spark.read.schema(schema).parquet(path)
    kept = stored.where("destino = 'dados'").select(*df.columns)
    rejected = stored.where("destino = 'quarentena'").select(
        *df.columns, reasons(F.col(MASK), rules).alias("motivos"))
    return kept, rejected, dict(seen.get)


def cleanse_visits(visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver visits without missing patients and cancellations, and their quarantine."""
    return split_rows(visits, [
        ("missing_patient", F.col("id_paciente").isNull()),
        ("cancelled", F.col("status") == "cancelada"),
    ])


def visit_quality(visits: DataFrame) -> DataFrame:
    """One row: total, rows without patient, rows per status, mean wait."""
    status = F.col("status")
    return visits.agg(
        F.count("*").alias("total_consultas"),
        F.count_if(F.col("id_paciente").isNull()).alias("paciente_nulo"),
        F.count_if(status == "finalizada").alias("finalizadas"),
        F.count_if(status == "cancelada").alias("canceladas"),
        F.count_if(status == "em_andamento").alias("em_andamento"),
        F.avg(F.col("tempo_espera_minutos")).alias("tempo_medio_min"),
    )
