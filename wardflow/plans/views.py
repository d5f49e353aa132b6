"""Joined views of the visit facts: 360 view, rated visits, labelled visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.functions import text as X
from wardflow.functions.lexicons import PRIORITY, PRIORITY_DEFAULT, RISK, RISK_DEFAULT
from wardflow.operators.integrity import left_join_optional, sent_if_small


def visits_360(visits: DataFrame, hospitals: DataFrame, patients: DataFrame) -> DataFrame:
    """Visits with their hospital and, where the patient is known, the patient.

    Visits without a patient stay, with NULL patient columns. Patients are joined first, so that the
    visits are shuffled for them without the hospital's names; hospitals within
    ``integrity.SENT_BYTES`` are sent to the visits.
    """
    # The specialty of a visit is the doctor's; a hospital's own has another meaning.
    places = hospitals.drop(*[c for c in hospitals.columns if c in visits.columns and c != "id_hospital"])
    known = left_join_optional(visits, "id_paciente", patients, "id_paciente",
                               spread_by=["id_consulta", "id_hospital", "id_medico"])
    names = ["id_hospital", *(c for frame in (visits, places, patients) for c in frame.columns
                              if c not in ("id_hospital", "id_paciente") or (frame is visits and c != "id_hospital"))]
    return known.join(sent_if_small(places), "id_hospital").select(*names)


def rated_visits(visits: DataFrame, reviews: DataFrame, problem: Column) -> DataFrame:
    """One row per review of a visit, with its sentiment score and extracted problem.

    ``reviews`` brings the sentiment as a stored column: text work is done once per text.
    """
    rated = reviews.select(
        "id_avaliacao", "id_consulta", "sentimento",
        X.sentiment_score(F.col("sentimento")).alias("nota"), problem.alias("problema"))
    return visits.join(rated, "id_consulta")


def enriched_visits(visits: DataFrame, text: str = "sintomas_relatados",
                    priority=PRIORITY, priority_default: str = PRIORITY_DEFAULT,
                    risk=RISK, risk_default: str = RISK_DEFAULT,
                    only: Sequence[str] = ("prioridade", "risco")) -> DataFrame:
    """Visits that have text, with priority and risk, or ``only`` one of them. Write the result
    as a table before dashboards read it, so that the texts are scanned once."""
    rules = {"prioridade": X.class_rule(priority, priority_default), "risco": X.class_rule(risk, risk_default)}
    labels = X.label_all(F.col(text), {name: rules[name] for name in only})
    return with_labels(visits.where(F.col(text).isNotNull()), labels)


def with_labels(df: DataFrame, labels: Column) -> DataFrame:
    """Add the fields of a label struct as columns."""
    return df.withColumn("__labels", labels).select(*df.columns, "__labels.*")


def risk_details(visits: DataFrame, fields: dict[str, str], text: str = "sintomas_relatados",
                 risk=RISK, risk_default: str = RISK_DEFAULT) -> DataFrame:
    """Visits that have text, with risk level and the extracted fields as one struct."""
    return visits.where(F.col(text).isNotNull()).withColumns({
        "nivel_risco": X.classify(F.col(text), risk, risk_default),
        "detalhes": X.extract_fields(F.col(text), fields),
    })


def risk_profile(visits: DataFrame, patients: DataFrame, as_of: Column) -> DataFrame:
    """Labelled visits of known patients with name, age (by calendar year) and plan."""
    people = patients.select("id_paciente", "nome_paciente", "convenio",
                             C.calendar_years(F.col("data_nascimento"), as_of).alias("idade"))
    return visits.join(people, "id_paciente")


def criticality(observations: DataFrame, text: str, lexicon, default: str,
                actions: dict[str, str]) -> DataFrame:
    """Observations with their criticality and the action the rules give for it."""
    level = X.classify(F.col(text), lexicon, default)
    return observations.withColumn("criticidade", level).withColumn(
        "acao_sugerida", C.by_value(F.col("criticidade"), actions, actions[default]))
