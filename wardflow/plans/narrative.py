"""Metrics as text: summary strings and template sentences, filled by rules.

Numbers go into the text as whole tenths computed in integer arithmetic, so the text does
not depend on how an engine prints a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import ratio


# Rules for the advice per group: mean wait in minutes, the first limit not reached decides.
ADVICE = [
    (20, "manter a escala atual"),
    (25, "abrir horarios extras nos dias de pico"),
    (30, "redistribuir a agenda entre as unidades"),
]
ADVICE_LAST = "reforcar a equipe com urgencia"


def tenths(total: Column, count: Column, factor: int = 1) -> Column:
    """``factor * total / count`` with one decimal, rounded half up, as text; whole numbers >= 0."""
    scaled = total.cast("long") * F.lit(20 * factor).cast("long") + count.cast("long")
    units = F.call_function("div", scaled, count.cast("long") * F.lit(2).cast("long"))
    ten = F.lit(10).cast("long")
    return F.concat(F.call_function("div", units, ten).cast("string"), F.lit("."),
                    F.pmod(units, ten).cast("string"))


def _waits(parts: DataFrame, key: str) -> DataFrame:
    """Totals per group from the partial sums of ``kpi.partials``; groups without waits drop out."""
    totals = parts.groupBy(key).agg(
        F.sum("n").alias("total_consultas"),
        F.sum("espera_soma").alias("espera_soma"),
        F.sum("espera_n").alias("espera_n"),
    )
    return totals.where(F.col("espera_n") > 0)


def metrics_text(parts: DataFrame) -> DataFrame:
    """One row: every specialty with visits and mean wait, sorted by name, in one string.

    The string has one part per specialty; the facts are reduced to those rows before.
    """
    wait = tenths(F.col("espera_soma"), F.col("espera_n"))
    part = F.concat(F.col("especialidade"), F.lit(": "), F.col("total_consultas").cast("string"),
                    F.lit(" consultas, espera media "), wait, F.lit(" min"))
    lines = _waits(parts, "especialidade").select("especialidade", part.alias("parte"))
    ordered = F.sort_array(F.collect_list(F.struct("especialidade", "parte")))
    return lines.agg(
        F.array_join(F.transform(ordered, lambda p: p["parte"]), ". ").alias("texto_metricas"))


def briefing_text(parts: DataFrame) -> DataFrame:
    """One row: the totals of the day as a fixed paragraph, from ``kpi.partials`` per hospital
    and specialty or finer."""
    totals = parts.agg(
        F.sum("n").alias("n"),
        F.count_distinct("id_hospital").alias("hospitais"),
        F.count_distinct("especialidade").alias("especialidades"),
        F.sum("espera_soma").alias("soma"),
        F.sum("espera_n").alias("com_espera"),
        F.sum("finalizadas").alias("fim"),
    )
    return totals.where(F.col("com_espera") > 0).select(F.concat(
        F.lit("Operacao do dia: "), F.col("n").cast("string"), F.lit(" consultas em "),
        F.col("hospitais").cast("string"), F.lit(" hospitais ativos cobrindo "),
        F.col("especialidades").cast("string"), F.lit(" especialidades. Tempo medio de espera: "),
        tenths(F.col("soma"), F.col("com_espera")), F.lit(" minutos. Taxa de conclusao: "),
        tenths(F.col("fim"), F.col("n"), factor=100), F.lit("%."),
    ).alias("briefing"))


def overall(parts: DataFrame) -> DataFrame:
    """One row: the bottleneck (longest mean wait) and the best specialty, as one sentence."""
    mean = ratio(F.col("espera_soma"), F.col("espera_n"))
    waits = _waits(parts, "especialidade").select(
        "especialidade", mean.alias("media"),
        tenths(F.col("espera_soma"), F.col("espera_n")).alias("texto"))
    # Equal means are decided by name: the smaller name wins at both ends.
    entry = F.struct((-F.col("media")).alias("m"), "especialidade", "texto")
    ends = waits.agg(
        F.min(entry).alias("pior"), F.min(F.struct("media", "especialidade", "texto")).alias("melhor"))
    return ends.select(F.concat(
        F.lit("Principal gargalo: "), F.col("pior.especialidade"), F.lit(", com espera media de "),
        F.col("pior.texto"), F.lit(" min. Melhor desempenho: "), F.col("melhor.especialidade"),
        F.lit(", com "), F.col("melhor.texto"), F.lit(" min."),
    ).alias("analise"))


def by_group(parts: DataFrame, key: str) -> DataFrame:
    """One sentence per group: its numbers and the advice the rules give for its wait."""
    mean = ratio(F.col("espera_soma"), F.col("espera_n"))
    advice = F.when(mean < ADVICE[0][0], ADVICE[0][1])
    for limit, words in ADVICE[1:]:
        advice = advice.when(mean < limit, words)
    return _waits(parts, key).select(
        key,
        F.concat(
            F.col(key).cast("string"), F.lit(" teve "), F.col("total_consultas").cast("string"),
            F.lit(" consultas com espera media de "),
            tenths(F.col("espera_soma"), F.col("espera_n")), F.lit(" min: "),
            advice.otherwise(ADVICE_LAST), F.lit("."),
        ).alias("recomendacao"),
    )


def by_hospital(busiest: DataFrame) -> DataFrame:
    """One sentence per hospital of ``kpi.busiest_hospitals``: name, city, visits, mean wait and
    number of specialties. Hospitals without a wait get no sentence."""
    wait = tenths(F.col("espera_soma"), F.col("espera_n"))
    return busiest.where(F.col("espera_n") > 0).select(
        "nome_hospital", "cidade",
        F.concat(
            F.col("nome_hospital"), F.lit(" ("), F.col("cidade"), F.lit("): "),
            F.col("total_consultas").cast("string"), F.lit(" consultas em "),
            F.col("especialidades_ativas").cast("string"), F.lit(" especialidades, espera media de "),
            wait, F.lit(" min."),
        ).alias("resumo"),
    )
