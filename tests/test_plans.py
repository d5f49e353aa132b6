"""KPIs and narratives on hand-made rows, and the shape of their plans."""

import datetime as dt
import uuid

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wardflow.functions import lexicons as L
from wardflow.functions import text as X
from wardflow.plans import kpi, narrative, views
from wardflow.testbed import QUERIES
from wardflow.testbed import binding as B

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hospitals(spark):
    return spark.createDataFrame([
        (1, "Santa", "Campinas", "SP", "Sudeste", 10, 2), (2, "Santa", "Campinas", "SP", "Sudeste", 5, 1),
        (3, "Norte", "Belem", "PA", "Norte", 4, 2),
    ], "id_hospital int, nome_hospital string, cidade string, estado string, regiao string, "
       "qtd_leitos int, qtd_medicos int")


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame([
        (101, "Ana", dt.date(1960, 5, 1), 63, "F", "SUS"), (102, "Beto", dt.date(2010, 1, 1), 14, "M", "Amil"),
    ], "id_paciente int, nome_paciente string, data_nascimento date, idade int, sexo string, convenio string")


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame([
        (1, 101, 1, 50, "Cardiologia", "finalizada", "presencial", 10, "I10", "HAS"),
        (2, 101, 1, 50, "Cardiologia", "cancelada", "telemedicina", 0, None, None),
        (3, None, 2, 51, "Pediatria", "finalizada", "retorno", 31, "J06", "IVAS"),
        (4, 102, 3, 51, "Pediatria", "em_andamento", "telemedicina", 20, None, None),
    ], "id_consulta int, id_paciente int, id_hospital int, id_medico int, especialidade string, "
       "status string, modalidade string, tempo_espera_minutos int, cid_10 string, "
       "diagnostico_descricao string")


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_per_hospital(visits, hospitals):
    found = by(kpi.per_hospital(visits, hospitals), "id_hospital")
    assert tuple(found[1])[1:] == (2, 5.0, 1, 1, "Santa", "Campinas")
    assert found[2]["pacientes_unicos"] == 0 and found[3]["pacientes_unicos"] == 1
    sketched = by(kpi.per_hospital(visits, hospitals, approximate=True), "id_hospital")
    assert {h: r["pacientes_unicos"] for h, r in sketched.items()} == {1: 1, 2: 0, 3: 1}


def test_names_shared_by_two_hospitals_are_one_group(visits, hospitals):
    top = kpi.busiest_hospitals(kpi.partials(visits, ["id_hospital", "especialidade"]), hospitals, 2).collect()
    assert [(r["nome_hospital"], r["total_consultas"], r["especialidades_ativas"]) for r in top] == [
        ("Santa", 3, 2), ("Norte", 1, 1)]
    assert top[0]["tempo_espera_medio"] == pytest.approx(41 / 3)


def test_view_360_and_demography(visits, hospitals, patients):
    assert views.visits_360(visits, hospitals, patients).count() == 4
    parts = kpi.partials(visits, ["id_hospital", "id_paciente", "especialidade", "cid_10", "diagnostico_descricao"])
    view = views.visits_360(parts.withColumns({"id_consulta": F.lit(0), "id_medico": F.lit(0)}), hospitals, patients)
    groups = by(kpi.demography(view), "convenio", "regiao")
    assert groups[(None, "Sudeste")]["total_pacientes"] == 0
    assert groups[("SUS", "Sudeste")]["faixa_etaria"] == "50-64"
    assert groups[("SUS", "Sudeste")]["cancelamentos"] == 1
    assert groups[("Amil", "Norte")]["taxa_telemedicina"] == 1.0
    diseases = by(kpi.epidemiology(view), "regiao", "cid_10")
    assert diseases[("Sudeste", "J06")]["idade_media"] is None
    assert diseases[("Sudeste", "I10")]["idade_media"] == 63.0
    per_patient = kpi.partials(visits, ["id_hospital", "id_paciente"])
    ages = by(kpi.age_plan_hospital(per_patient, patients), "id_hospital")
    assert ages.keys() == {1, 3} and (ages[1]["total_consultas"], ages[1]["pacientes"]) == (2, 1)


def test_doctor_load_cohort(visits, hospitals, patients):
    doctors = by(kpi.per_doctor(kpi.partials(visits, ["id_medico"]), ["id_medico"]), "id_medico")
    assert (doctors[50]["presenciais"], doctors[50]["telemedicina"]) == (1, 1)
    load = by(kpi.load_per_capacity(visits, hospitals), "id_hospital")
    assert load[2]["consultas_por_leito"] == 0.2
    region = by(kpi.load_by_region(visits, hospitals), "regiao")
    assert region["Sudeste"]["consultas_por_leito"] == 0.2
    assert [r["id_paciente"] for r in kpi.cohort(patients, "SUS", 60).collect()] == [101]
    per_code = kpi.partials(visits, ["id_medico", "especialidade", "cid_10"])
    assert [(r["especialidade"], r["cid_10"]) for r in kpi.top_codes(per_code).orderBy("cid_10").collect()] == [
        ("Cardiologia", "I10"), ("Pediatria", "J06")]


def test_empty_facts_give_empty_kpis(visits, hospitals, patients):
    none = visits.where("false")
    parts = kpi.partials(none, ["id_hospital", "especialidade"])
    for df in (kpi.per_hospital(none, hospitals), kpi.by_specialty(parts), kpi.busiest_hospitals(parts, hospitals),
               narrative.by_group(kpi.partials(none, ["id_hospital"]), "id_hospital"), narrative.briefing_text(parts)):
        assert df.count() == 0
    assert kpi.daily_totals(parts).first()["total_consultas"] == 0


def test_channels_by_the_hospitals_city(spark, visits, hospitals):
    reviews = spark.createDataFrame([(1, "App", 10, True), (3, "App", 31, False), (4, "SMS", 5, None), (99, "App", 1, True)],
                                    "id_consulta int, canal_avaliacao string, tempo_para_avaliar_min int, avaliacao_anonima boolean")
    found = by(kpi.per_channel(reviews, visits, hospitals), "canal_avaliacao", "cidade")
    assert tuple(found[("App", "Campinas")])[2:] == (2, 20.5, 0.5, 20.5)
    assert tuple(found[("SMS", "Belem")])[2:] == (1, 5.0, 0.0, 20.0)


def test_hospital_sentences(visits, hospitals):
    parts = kpi.partials(visits, ["id_hospital", "especialidade"])
    made = by(narrative.by_hospital(kpi.busiest_hospitals(parts, hospitals, 2)), "nome_hospital")
    assert made["Santa"]["resumo"] == "Santa (Campinas): 3 consultas em 2 especialidades, espera media de 13.7 min."


def test_narratives(visits):
    parts = kpi.partials(visits, ["id_medico", "id_hospital", "especialidade"])
    assert narrative.metrics_text(parts).first()[0] == (
        "Cardiologia: 2 consultas, espera media 5.0 min. Pediatria: 2 consultas, espera media 25.5 min")
    assert narrative.overall(parts).first()[0] == (
        "Principal gargalo: Pediatria, com espera media de 25.5 min. "
        "Melhor desempenho: Cardiologia, com 5.0 min.")
    assert narrative.briefing_text(parts).first()[0] == (
        "Operacao do dia: 4 consultas em 3 hospitais ativos cobrindo 2 especialidades. "
        "Tempo medio de espera: 15.3 minutos. Taxa de conclusao: 50.0%.")
    advice = by(narrative.by_group(parts, "id_hospital"), "id_hospital")
    assert advice[2]["recomendacao"].endswith("reforcar a equipe com urgencia.")
    assert advice[3]["recomendacao"].endswith("20.0 min: abrir horarios extras nos dias de pico.")


@pytest.fixture(scope="module")
def complaints(spark):
    return spark.createDataFrame([
        (1, 101, 1, "Cardiologia", 12, "finalizada", "Chegou com dor torácica aguda há 50 minutos e falta de ar"),
        (2, 102, 1, "Pediatria", 30, "finalizada", "Veio para acompanhamento de rotina, nada a relatar"),
        (3, 102, 2, "Pediatria", 25, "cancelada", None),
    ], "id_consulta int, id_paciente int, id_hospital int, especialidade string, "
       "tempo_espera_minutos int, status string, sintomas_relatados string")


def test_enriched_visits(complaints, hospitals, patients):
    labelled = views.enriched_visits(complaints)
    found = by(labelled, "id_consulta")
    assert found.keys() == {1, 2}
    assert (found[1]["prioridade"], found[1]["risco"]) == ("urgente", "alto_risco")
    assert (found[2]["prioridade"], found[2]["risco"]) == ("eletiva", "baixo_risco")
    assert "risco" not in views.enriched_visits(complaints, only=["prioridade"]).columns
    parts = kpi.partials(labelled, ["id_hospital", "prioridade", "risco"])
    assert [r["id_hospital"] for r in kpi.urgent_hospitals(parts, hospitals).collect()] == [1]
    assert kpi.riskiest_hospitals(parts, hospitals).first()["risco_medio"] == 1.0
    assert by(kpi.wait_by_priority(parts), "prioridade")["eletiva"]["tempo_espera_medio"] == 30.0
    profile = views.risk_profile(labelled, patients, F.lit("2024-01-31").cast("date"))
    assert by(profile, "id_consulta")[1]["idade"] == 64
    detail = by(views.risk_details(complaints, X.SYMPTOM_FIELDS), "id_consulta")
    assert detail[1]["detalhes"]["duracao"] == "50 minutos"


def test_criticality(spark):
    notes = spark.createDataFrame([("Forte aumento de casos urgentes na ala norte neste mês",),
                                   ("A ala infantil virou referência em conclusão de consultas",)], "o string")
    found = views.criticality(notes, "o", L.CRITICALITY, L.CRITICALITY_DEFAULT, L.ACTION).collect()
    assert [r["criticidade"] for r in found] == ["problema_critico", "destaque_positivo"]
    assert found[0]["acao_sugerida"] == L.ACTION["problema_critico"]


def test_rated_visits(spark, visits):
    reviews = spark.createDataFrame([(9, 1, "negative", "fila"), (10, 3, "positive", None)],
                                    "id_avaliacao int, id_consulta int, sentimento string, campo string")
    found = by(views.rated_visits(visits, reviews, F.col("campo")), "id_consulta")
    assert (found[1]["nota"], found[1]["problema"]) == (-1, "fila")
    assert found[3]["nota"] == 1


# ---- plans ----

def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(QUERIES["kpi_hospital"](spark, SF))
    lines = next(p for p in plan.split("FileScan") if "lineitem.parquet" in p)
    schema = lines.split("ReadSchema:")[1].split("\n")[0]
    assert "l_quantity" in schema and "l_extendedprice" not in schema and "l_partkey" not in schema


def scan_of(plan, table):
    return next(p for p in plan.split("FileScan") if f"{table}.parquet" in p)


def test_filters_reach_the_scan(spark):
    # A plan that only filters, so that no step before it is stored and cut off.
    plan = plan_of(QUERIES["filter_status"](spark, SF))
    assert "o_orderstatus" in scan_of(plan, "orders").split("PushedFilters:")[1].split("\n")[0]
    finished = plan_of(QUERIES["label_distribution"](spark, SF).where("prioridade = '1-URGENT'"))
    assert "EqualTo" not in scan_of(finished, "orders")  # the share needs all rows: it must not be pushed


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "scalar_counts"])
def test_no_query_has_a_product_of_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,most", [("kpi_epidemiology", 15), ("kpi_demography", 13), ("age_plan_hospital", 8),
                                       ("daily_briefing_metrics", 6), ("kpi_channel", 10)])
def test_shuffles_without_broadcasts(spark, name, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF))
        assert plan.count("Exchange hashpartitioning") <= most, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def jobs_started(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_building_a_query_runs_nothing(spark):
    # Reading a folder looks at one file's footer; nothing else starts.
    assert jobs_started(spark, lambda: spark.read.parquet(f"{SF}/conversations.parquet")) <= 1
    assert jobs_started(spark, lambda: QUERIES["text_similarity"](spark, SF)) <= 1
    assert jobs_started(spark, lambda: QUERIES["kpi_channel"](spark, SF)) <= 8


def test_text_labels_stay_in_the_jvm(spark):
    df = B.documents(spark, SF).select(X.classify(F.col("text"), L.PRIORITY, L.PRIORITY_DEFAULT))
    assert "Python" not in plan_of(df)


@pytest.mark.parametrize("name,absent", [
    ("kpi_epidemiology", "keys=[id_hospital"), ("kpi_epidemiology", "Exchange hashpartitioning(id_hospital"),
    ("visits_360", "Exchange hashpartitioning(id_hospital")])
def test_visits_are_neither_grouped_nor_moved_for_hospitals(spark, name, absent):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert absent not in plan_of(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_view_360_with_a_large_table_of_hospitals(visits, hospitals, patients, monkeypatch):
    from wardflow.operators import integrity

    small = views.visits_360(visits, hospitals, patients)
    monkeypatch.setattr(integrity, "SENT_BYTES", 0)
    large = views.visits_360(visits, hospitals, patients)
    assert small.columns == large.columns and sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
