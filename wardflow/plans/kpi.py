"""KPI tables. Inputs are the reference-shaped frames, outputs one row per group.

Where the grouping columns depend on one id, the facts are aggregated by the id first and
the few result rows are joined to the dimension, so facts are not shuffled for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.functions import text as X
from wardflow.functions.lexicons import RISK_LEVELS
from wardflow.operators.ranking import first_n, top_k_in_group
from wardflow.operators.shares import label_shares



def _wait() -> Column:
    return F.avg("tempo_espera_minutos")


def partials(visits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and sums per key, which later steps add up to any coarser grain. Status and
    mode are counted where the facts have them.

    Reducing the facts by an id before the id's dimension is joined leaves one row per id
    for the join's shuffle, and splits a hot id over all tasks that read it.
    """
    measures = [
        F.count("*").alias("n"),
        F.sum(F.col("tempo_espera_minutos").cast("long")).alias("espera_soma"),
        F.count("tempo_espera_minutos").alias("espera_n"),
    ]
    if "status" in visits.columns:
        measures += [F.count_if(F.col("status") == "finalizada").alias("finalizadas"),
                     F.count_if(F.col("status") == "cancelada").alias("canceladas")]
    if "modalidade" in visits.columns:
        measures += [F.count_if(F.col("modalidade") == "presencial").alias("presenciais"),
                     F.count_if(F.col("modalidade") == "telemedicina").alias("telemedicina")]
    return visits.groupBy(*keys).agg(*measures)


def as_partials(visits: DataFrame) -> DataFrame:
    """The measures of :func:`partials` with a row for every visit, for keys so fine that grouping by
    them reduces nothing and only fills the tasks' memory."""
    wait = F.col("tempo_espera_minutos")
    return visits.withColumns({
        "n": F.lit(1).cast("long"), "espera_soma": wait.cast("long"),
        "espera_n": wait.isNotNull().cast("int").cast("long")})


def _total_wait() -> Column:
    return C.ratio(F.sum("espera_soma"), F.sum("espera_n")).alias("tempo_espera_medio")


def per_hospital(visits: DataFrame, hospitals: DataFrame, approximate: bool = False,
                 specialty: bool = False) -> DataFrame:
    """Visits, mean wait, cancellations, distinct patients of every hospital.

    ``approximate`` counts patients by a sketch: one shuffle less, a few percent off.
    ``specialty`` adds the hospital's specialty to the key.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    facts = visits.groupBy("id_hospital").agg(
        F.count("*").alias("total_consultas"),
        _wait().alias("tempo_espera_medio"),
        F.count_if(F.col("status") == "cancelada").alias("cancelamentos"),
        distinct("id_paciente").alias("pacientes_unicos"),
    )
    names = ["id_hospital", "nome_hospital", "cidade"] + (["especialidade"] if specialty else [])
    return facts.join(hospitals.select(*names), "id_hospital")


def per_channel(reviews: DataFrame, visits: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Reviewed visits, mean time to review, share of anonymous reviews, mean wait per channel
    and city of the hospital.

    Reviews meet visits on the visit id. What they give is added up per channel and hospital
    before the hospital's city comes in.
    """
    joined = reviews.select("id_consulta", "canal_avaliacao", "tempo_para_avaliar_min", "avaliacao_anonima").join(
        visits.select("id_consulta", "id_hospital", "tempo_espera_minutos"), "id_consulta")
    delay = F.col("tempo_para_avaliar_min").cast("double")
    parts = joined.groupBy("canal_avaliacao", "id_hospital").agg(
        F.count("*").alias("n"), F.sum(delay).alias("demora_soma"), F.count(delay).alias("demora_n"),
        F.count_if(F.col("avaliacao_anonima")).alias("anonimas"),
        F.sum(F.col("tempo_espera_minutos").cast("long")).alias("espera_soma"),
        F.count("tempo_espera_minutos").alias("espera_n"))
    return parts.join(hospitals.select("id_hospital", "cidade"), "id_hospital").groupBy(
        "canal_avaliacao", "cidade").agg(
        F.sum("n").alias("total_avaliacoes"),
        C.ratio(F.sum("demora_soma"), F.sum("demora_n")).alias("avg_tempo_para_avaliar"),
        C.ratio(F.sum("anonimas"), F.sum("n")).alias("taxa_anonimato"),
        _total_wait(),
    )


def epidemiology(parts: DataFrame) -> DataFrame:
    """Visits, distinct patients, mean age, mean wait per region, state, specialty and code, from
    :func:`partials` per patient and at least as fine as these keys, with ``idade``."""
    keys = ["regiao", "estado", "especialidade", "cid_10", "diagnostico_descricao"]
    age = F.col("idade").cast("long")
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("total_consultas"),
        F.count_distinct("id_paciente").alias("pacientes_distintos"),
        C.ratio(F.sum(age * F.col("n")), F.sum(F.when(age.isNotNull(), F.col("n")))).alias("idade_media"),
        _total_wait(),
    )


def per_doctor(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visits by mode and mean wait per doctor, from :func:`partials`; ``keys`` sets the grain."""
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("total_consultas"),
        F.sum("presenciais").alias("presenciais"),
        F.sum("telemedicina").alias("telemedicina"),
        _total_wait(),
    )


def demography(parts: DataFrame) -> DataFrame:
    """Patients, visits, cancellations, wait, telemedicine share per plan, sex, age band, region,
    from :func:`partials` per patient and region or finer, with the patient's columns."""
    banded = parts.withColumn("faixa_etaria", C.age_band(F.col("idade")))
    return banded.groupBy("convenio", "sexo", "faixa_etaria", "regiao").agg(
        F.count_distinct("id_paciente").alias("total_pacientes"),
        F.sum("n").alias("total_consultas"),
        F.sum("canceladas").alias("cancelamentos"),
        _total_wait(),
        C.ratio(F.sum("telemedicina"), F.sum("n")).alias("taxa_telemedicina"),
    )


def by_specialty(parts: DataFrame) -> DataFrame:
    """Visits, mean wait, completion percentage per specialty, from :func:`partials`."""
    return parts.groupBy("especialidade").agg(
        F.sum("n").alias("total_consultas"),
        _total_wait(),
        (C.ratio(F.sum("finalizadas"), F.sum("n")) * 100.0).alias("taxa_conclusao_pct"),
    )


def daily_totals(parts: DataFrame) -> DataFrame:
    """One row: visits, active hospitals, specialties, mean wait, completion percentage, from
    :func:`partials` per hospital and specialty or finer."""
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_consultas"),
        F.count_distinct("id_hospital").alias("hospitais_ativos"),
        F.count_distinct("especialidade").alias("especialidades"),
        _total_wait(),
        (C.ratio(F.sum("finalizadas"), F.sum("n")) * 100.0).alias("taxa_conclusao"),
    )


def busiest_hospitals(parts: DataFrame, hospitals: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` hospital names by visits, with mean wait and number of specialties, from
    :func:`partials` per hospital and specialty or finer.

    The group is (name, city), and a name may belong to several ids: so the specialties are
    counted after the join, over the reduced rows.
    """
    names = hospitals.select("id_hospital", "nome_hospital", "cidade")
    totals = parts.join(names, "id_hospital").groupBy("nome_hospital", "cidade").agg(
        F.sum("n").alias("total_consultas"),
        _total_wait(),
        F.count_distinct("especialidade").alias("especialidades_ativas"),
        F.sum("espera_soma").alias("espera_soma"),
        F.sum("espera_n").alias("espera_n"),
    )
    return first_n(totals, k, [F.desc("total_consultas"), F.asc("nome_hospital"), F.asc("cidade")])


def hospital_scores(visits: DataFrame, review_scores: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Volume, mean wait and mean sentiment per hospital.

    ``review_scores`` has one row per visit id: sum and number of its review scores.
    """
    joined = visits.join(review_scores, "id_consulta", "left")
    facts = joined.groupBy("id_hospital").agg(
        F.count("*").alias("volume"),
        _wait().alias("tempo_espera_medio"),
        C.ratio(F.sum("nota_soma"), F.sum("nota_n")).alias("sentimento_medio"),
    )
    return facts.join(hospitals.select("id_hospital", "nome_hospital"), "id_hospital")


def scores_by_visit(reviews: DataFrame) -> DataFrame:
    note = X.sentiment_score(F.col("sentimento"))
    return reviews.groupBy("id_consulta").agg(
        F.sum(note).alias("nota_soma"), F.count(note).alias("nota_n"))


def top_codes(parts: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent codes of finished visits per specialty, from :func:`partials`."""
    counts = (
        parts.where((F.col("finalizadas") > 0) & F.col("cid_10").isNotNull())
        .groupBy("especialidade", "cid_10").agg(F.sum("finalizadas").alias("total"))
    )
    return top_k_in_group(counts, k, ["especialidade"], [F.desc("total"), F.asc("cid_10")])


def urgent_hospitals(parts: DataFrame, hospitals: DataFrame, k: int = 5) -> DataFrame:
    """Hospitals with the most urgent visits, from labelled :func:`partials`."""
    counts = (
        parts.where(F.col("prioridade") == "urgente")
        .groupBy("id_hospital").agg(F.sum("n").alias("urgentes"))
    )
    best = first_n(counts, k, [F.desc("urgentes"), F.asc("id_hospital")])
    return best.join(hospitals.select("id_hospital", "nome_hospital"), "id_hospital")


def _risk_level() -> Column:
    return C.by_value(F.col("risco"), RISK_LEVELS, None).cast("int")


def _mean_risk() -> Column:
    """Mean risk level over the rows that labelled parts stand for; rows without level are left out."""
    level = _risk_level()
    return C.ratio(F.sum(level * F.col("n")), F.sum(F.when(level.isNotNull(), F.col("n"))))


def risk_by_specialty(parts: DataFrame) -> DataFrame:
    """High-risk visits, their share, and the mean risk level (0, 1, 2) per specialty, from
    labelled :func:`partials`."""
    high = F.sum(F.when(F.col("risco") == "alto_risco", F.col("n")).otherwise(0))
    return parts.groupBy("especialidade").agg(
        F.sum("n").alias("total_consultas"),
        high.alias("alto_risco"),
        (C.ratio(high, F.sum("n")) * 100.0).alias("percentual_alto"),
        _mean_risk().alias("risco_medio"),
    )


def riskiest_hospitals(parts: DataFrame, hospitals: DataFrame, k: int = 3) -> DataFrame:
    """Hospitals with the highest mean risk level, from labelled :func:`partials`."""
    means = parts.groupBy("id_hospital").agg(
        _mean_risk().alias("risco_medio"), F.sum("n").alias("total_consultas"))
    best = first_n(means, k, [F.desc("risco_medio"), F.asc("id_hospital")])
    return best.join(hospitals.select("id_hospital", "nome_hospital"), "id_hospital")


def wait_by_priority(parts: DataFrame, labels: Sequence[str] = ("urgente", "eletiva")) -> DataFrame:
    """Visits and mean wait of some priorities, from labelled :func:`partials`."""
    return parts.where(F.col("prioridade").isin(*labels)).groupBy("prioridade").agg(
        F.sum("n").alias("total_consultas"), _total_wait())


def counts_by(df: DataFrame, keys: Sequence[str], name: str = "total", n: str | None = None) -> DataFrame:
    """Rows per key; ``n``: a column with the number of rows that a row stands for."""
    return df.groupBy(*keys).agg((F.sum(n) if n else F.count("*")).alias(name))


def sentiment_by_wait_band(rated: DataFrame) -> DataFrame:
    """Label counts and their share inside each waiting band."""
    banded = rated.withColumn("faixa_espera", C.wait_band(F.col("tempo_espera_minutos")))
    return label_shares(banded, ["sentimento"], ["faixa_espera"])


def wait_sentiment_correlation(rated: DataFrame) -> DataFrame:
    """One row: Pearson correlation of the wait and the review score; NULL if one is constant.

    Spark's aggregates keep running means instead of sums of squares, so large values do not
    cancel. Round it where two runs are compared: the row order can change the last bits.
    """
    wait, score = F.col("tempo_espera_minutos").cast("double"), F.col("nota").cast("double")
    x, y = F.when(score.isNotNull(), wait), F.when(wait.isNotNull(), score)
    return rated.agg(F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("correlacao"))


def load_per_capacity(visits: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Visits per bed and per doctor post of every hospital, with region and state."""
    counts = visits.groupBy("id_hospital").agg(F.count("*").alias("total_consultas"))
    places = hospitals.select("id_hospital", "regiao", "estado", "qtd_leitos", "qtd_medicos")
    n = F.col("total_consultas")
    return counts.join(places, "id_hospital").select(
        "id_hospital", "regiao", "estado", "total_consultas",
        C.ratio(n, F.col("qtd_leitos")).alias("consultas_por_leito"),
        C.ratio(n, F.col("qtd_medicos")).alias("consultas_por_medico"),
    )


def load_by_region(visits: DataFrame, hospitals: DataFrame) -> DataFrame:
    """The same load per region and state: total visits over total beds and doctor posts."""
    per_place = load_per_capacity(visits, hospitals).join(
        hospitals.select("id_hospital", "qtd_leitos", "qtd_medicos"), "id_hospital")
    n = F.sum("total_consultas")
    return per_place.groupBy("regiao", "estado").agg(
        F.sum("total_consultas").alias("total_consultas"),
        C.ratio(n, F.sum("qtd_leitos")).alias("consultas_por_leito"),
        C.ratio(n, F.sum("qtd_medicos")).alias("consultas_por_medico"),
    )


def telemedicine_ratio(parts: DataFrame) -> DataFrame:
    """Share of telemedicine per specialty, from :func:`partials`."""
    return parts.groupBy("especialidade").agg(
        F.sum("n").alias("total_consultas"),
        C.ratio(F.sum("telemedicina"), F.sum("n")).alias("taxa_telemedicina"),
    )


def age_plan_hospital(parts: DataFrame, patients: DataFrame) -> DataFrame:
    """Visits and distinct patients per age band, plan and hospital, known patients only.

    ``parts``: :func:`partials` with one row per hospital and patient, so that patients are
    counted without a second look at the visits.
    """
    people = patients.select("id_paciente", "idade", "convenio")
    known = parts.where(F.col("id_paciente").isNotNull()).join(people, "id_paciente", "left")
    return (
        known.withColumn("faixa_etaria", C.age_band(F.col("idade")))
        .groupBy("faixa_etaria", "convenio", "id_hospital")
        .agg(F.sum("n").alias("total_consultas"), F.count("*").alias("pacientes"))
    )


def cohort(patients: DataFrame, plan: str, older_than: int) -> DataFrame:
    """Patients of one plan above an age."""
    return patients.where((F.col("convenio") == plan) & (F.col("idade") > older_than))
