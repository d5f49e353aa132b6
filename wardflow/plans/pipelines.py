"""The medallion jobs end to end: raw directories to bronze, silver and gold tables.

Each job reads what the one before has stored and writes its own tables, so a job can be
repeated alone. ``layers`` is what ``tables.create_layers`` returns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions import text as X
from wardflow.operators import integrity
from wardflow.plans import kpi, views
from wardflow.sources import files, ingest, tables

MALFORMED = "malformed"
LAST_RUN = "wardflow.carga"  # property of a table: the last run whose rows it has


def store_visits(spark: SparkSession, landing: str, schema: T.StructType, layers: Mapping[str, str],
                 required: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``silver.consultas`` and ``silver.consultas_quarentena`` from a raw directory of visits.

    The quarantine has the malformed lines (with their text), the visits without a patient and
    the cancelled ones, each with its reason.
    """
    rows = files.read_csv_dir(spark, landing, schema, header=header)
    good, malformed = files.split_malformed(rows, required)
    kept, rejected = integrity.cleanse_visits(good)
    silver = layers["silver"]
    quarantine = rejected.unionByName(
        malformed.withColumn("motivo", F.lit(MALFORMED)), allowMissingColumns=True)
    return (tables.create_table(kept, f"{silver}.consultas", schema),
            tables.create_table(quarantine, f"{silver}.consultas_quarentena"))


def land_visits(spark: SparkSession, landing: str, root: str, schema: T.StructType, layers: Mapping[str, str],
                required: Sequence[str], header: bool = True) -> int:
    """The visits' tables of :func:`store_visits` from a directory that grows: only files that are new
    are read (see :mod:`ingest`). The number of files read.

    Rows of new files are added to silver and its quarantine; where a file has been read again, both
    are made anew from what is stored. A run that broke off between the store and the tables is
    made up for: the tables name the last run that they have.
    """
    silver = layers["silver"]
    name, rejects = f"{silver}.consultas", f"{silver}.consultas_quarentena"
    count = ingest.land(spark, landing, root, schema, required, header)
    published = ingest.runs(spark, root)
    held = tables.property_of(spark, name, LAST_RUN) if spark.catalog.tableExists(name) else None
    if not published or held == published[-1]:
        return count
    added = held in published and not ingest.reread(spark, root, held)
    since = held if added else None
    # Rows keep the run that they came with as their partition: what a run that broke off here has
    # left in the tables is replaced, not added a second time.
    rows = ingest.current(spark, root, schema, since=since).select(*schema.names, ingest.RUN)
    bad = ingest.current(spark, root, schema, "quarentena", since=since).select(
        *schema.names, files.RAW_LINE, ingest.RUN)
    kept, rejected = integrity.cleanse_visits(rows)
    quarantine = rejected.unionByName(bad.withColumn("motivo", F.lit(MALFORMED)), allowMissingColumns=True)
    for made, table in ((kept, name), (quarantine, rejects)):
        if added:
            tables.replace_partitions(made, table)
        else:
            tables.create_table(made, table, partition_by=[ingest.RUN])
    tables.set_property(spark, name, LAST_RUN, published[-1])
    return count


def store_reviews(spark: SparkSession, landing: str, schema: T.StructType, layers: Mapping[str, str],
                  required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``bronze.avaliacoes`` and ``bronze.avaliacoes_quarentena`` from a raw directory of reviews,
    free text included."""
    rows = files.read_csv_dir(spark, landing, schema, free_text=True)
    good, malformed = files.split_malformed(rows, required)
    bronze = layers["bronze"]
    return (tables.create_table(good, f"{bronze}.avaliacoes", schema),
            tables.create_table(malformed, f"{bronze}.avaliacoes_quarentena"))


def store_360(spark: SparkSession, hospitals: DataFrame, patients: DataFrame,
              layers: Mapping[str, str]) -> DataFrame:
    """``silver.consultas_360``: the stored visits with hospital and patient."""
    visits = spark.table(f"{layers['silver']}.consultas")
    return tables.create_table(views.visits_360(visits, hospitals, patients), f"{layers['silver']}.consultas_360")


def store_rated(spark: SparkSession, positive: Sequence[str], negative: Sequence[str], problem: str,
                layers: Mapping[str, str]) -> DataFrame:
    """``silver.consultas_avaliadas``: stored visits with their reviews' sentiment, score and the
    first match of ``problem``."""
    text = F.col("texto_avaliacao")
    reviews = spark.table(f"{layers['bronze']}.avaliacoes").select(
        "id_consulta", "canal_avaliacao", X.sentiment(text, positive, negative).alias("sentimento"),
        X.extract_fields(text, {"problema": problem})["problema"].alias("problema"))
    rated = reviews.withColumn("nota", X.sentiment_score(F.col("sentimento")))
    visits = spark.table(f"{layers['silver']}.consultas").select(
        "id_consulta", "id_hospital", "id_medico", "tempo_espera_minutos")
    return tables.create_table(visits.join(rated, "id_consulta"), f"{layers['silver']}.consultas_avaliadas")


def store_gold(spark: SparkSession, hospitals: DataFrame, layers: Mapping[str, str]) -> DataFrame:
    """``gold.kpis_clinica``: volume, mean wait and mean sentiment per hospital, from the stored
    visits and the stored reviews."""
    reviews = spark.table(f"{layers['bronze']}.avaliacoes")
    rated = spark.table(f"{layers['silver']}.consultas_avaliadas")
    scores = rated.groupBy("id_hospital").agg(F.sum("nota").alias("nota_soma"), F.count("nota").alias("nota_n"))
    parts = kpi.partials(spark.table(f"{layers['silver']}.consultas"), ["id_hospital"])
    facts = parts.join(scores, "id_hospital", "left").join(
        hospitals.select("id_hospital", "nome_hospital"), "id_hospital")
    made = facts.select(
        "id_hospital", "nome_hospital", F.col("n").alias("volume"),
        F.try_divide(F.col("espera_soma").cast("double"), F.col("espera_n").cast("double")).alias("tempo_espera_medio"),
        F.try_divide(F.col("nota_soma").cast("double"), F.col("nota_n").cast("double")).alias("sentimento_medio"),
        reviews.agg(F.count("*")).scalar().alias("avaliacoes_recebidas"))
    return tables.create_table(made, f"{layers['gold']}.kpis_clinica")
