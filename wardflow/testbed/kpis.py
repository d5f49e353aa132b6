"""KPI queries over the bound visits, reviews and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.functions import text as X
from wardflow.operators import integrity, moments, ranking, shares
from wardflow.plans import kpi, narrative, views
from wardflow.testbed import binding as B
from wardflow.testbed.registry import query


@query("kpi_hospital", f"""
WITH {B.V360}
SELECT id_hospital, nome_hospital, cidade, especialidade_hospital AS especialidade,
       count(*) AS total_consultas, avg(tempo_espera_minutos) AS tempo_espera_medio,
       count(CASE WHEN status = 'cancelada' THEN 1 END) AS cancelamentos,
       count(DISTINCT id_paciente) AS pacientes_unicos
FROM v360 GROUP BY ALL""")
def kpi_hospital(spark, sf):
    return kpi.per_hospital(B.visits(spark, sf, codes=False), B.hospitals(spark, sf), specialty=True)


@query("kpi_channel", f"""
WITH {B.V}, {B.H}, {B.R}
SELECT canal_avaliacao, cidade, count(*) AS total_avaliacoes,
       avg(tempo_para_avaliar_min) AS avg_tempo_para_avaliar,
       CAST(count(CASE WHEN avaliacao_anonima THEN 1 END) AS DOUBLE) / count(*) AS taxa_anonimato,
       avg(tempo_espera_minutos) AS tempo_espera_medio
FROM r JOIN v ON v.id_consulta = r.id_consulta JOIN h ON h.id_hospital = v.id_hospital
GROUP BY canal_avaliacao, cidade""")
def kpi_channel(spark, sf):
    return kpi.per_channel(B.reviews(spark, sf), B.lines(spark, sf), B.hospitals(spark, sf))


def patient_parts(spark, sf, *more):
    """Partial sums per hospital, patient and ``more``: what all KPIs by patient start from."""
    return kpi.partials(B.visits(spark, sf, codes=False), ["id_hospital", "id_paciente", *more])


def view_360(spark, sf):
    return views.visits_360(B.visits(spark, sf), B.hospitals(spark, sf), B.patients(spark, sf))


@query("visits_360", f"""
WITH {B.V360}
SELECT id_consulta, id_hospital, id_medico, tempo_espera_minutos, modalidade, id_paciente, status,
       especialidade, cid_10, nome_hospital, regiao, nome_paciente,
       CAST(data_nascimento AS VARCHAR) AS data_nascimento, idade, sexo, convenio
FROM v360""")
def visits_360(spark, sf):
    return view_360(spark, sf).select(
        "id_consulta", "id_hospital", "id_medico", "tempo_espera_minutos", "modalidade",
        "id_paciente", "status", "especialidade", "cid_10", "nome_hospital", "regiao",
        "nome_paciente", F.col("data_nascimento").cast("string").alias("data_nascimento"),
        "idade", "sexo", "convenio")


@query("kpi_epidemiology", f"""
WITH {B.V360}
SELECT regiao, estado, especialidade, cid_10, diagnostico_descricao,
       count(*) AS total_consultas, count(DISTINCT id_paciente) AS pacientes_distintos,
       avg(idade) AS idade_media, avg(tempo_espera_minutos) AS tempo_espera_medio
FROM v360 GROUP BY ALL""")
def kpi_epidemiology(spark, sf):
    """Ids through the joins, the narrowest dimension first; one row a visit, because hardly two visits
    share patient, hospital and doctor."""
    visits = B.visits(spark, sf, codes=False).drop("modalidade")
    places = B.hospitals(spark, sf).select("id_hospital", "regiao", "estado")
    ages = B.patients(spark, sf).select("id_paciente", "idade")
    aged = integrity.left_join_optional(
        visits, "id_paciente", ages, "id_paciente", ["id_consulta", "id_hospital", "id_medico"]).drop("id_consulta")
    coded = aged.join(integrity.sent_if_small(places), "id_hospital").join(B.codes(spark, sf), "id_medico").withColumns({
        c: F.when(F.col("status") == "finalizada", F.col(c)) for c in ("cid_10", "diagnostico_descricao")})
    return kpi.epidemiology(kpi.as_partials(coded))


def _doctor_sql(keys: str, source: str = "v") -> str:
    return f"""
WITH {B.V}
SELECT {keys}, count(*) AS total_consultas,
       count(CASE WHEN modalidade = 'presencial' THEN 1 END) AS presenciais,
       count(CASE WHEN modalidade = 'telemedicina' THEN 1 END) AS telemedicina,
       avg(tempo_espera_minutos) AS tempo_espera_medio
FROM {source} GROUP BY ALL"""


def _parts_with_specialty(spark, sf):
    """Partial sums per doctor id, then the specialty: the facts are reduced before the join."""
    sums = kpi.partials(B.lines(spark, sf), ["id_medico"])
    return sums.join(B.specialties(spark, sf), "id_medico")


def day_parts(spark, sf):
    """Partial sums per hospital and doctor, then the specialty."""
    sums = kpi.partials(B.visits(spark, sf, codes=False), ["id_hospital", "id_medico"])
    return sums.join(B.specialties(spark, sf), "id_medico")


@query("kpi_doctor", _doctor_sql(
    "id_medico, nome_medico, crm, especialidade",
    "v JOIN (SELECT p_partkey, p_name AS nome_medico, p_brand AS crm FROM part) ON p_partkey = id_medico"))
def kpi_doctor(spark, sf):
    sums = kpi.partials(B.lines(spark, sf), ["id_medico"])
    return kpi.per_doctor(sums.join(B.doctors(spark, sf), "id_medico"),
                          ["id_medico", "nome_medico", "crm", "especialidade"])


@query("kpi_doctor_id", _doctor_sql("id_medico"))
def kpi_doctor_id(spark, sf):
    return kpi.per_doctor(kpi.partials(B.lines(spark, sf), ["id_medico"]), ["id_medico"])


@query("kpi_demography", f"""
WITH {B.V360}
SELECT convenio, sexo, {B.AGE_BAND_SQL} AS faixa_etaria, regiao,
       count(DISTINCT id_paciente) AS total_pacientes, count(*) AS total_consultas,
       count(CASE WHEN status = 'cancelada' THEN 1 END) AS cancelamentos,
       avg(tempo_espera_minutos) AS tempo_espera_medio,
       CAST(count(CASE WHEN modalidade = 'telemedicina' THEN 1 END) AS DOUBLE) / count(*)
         AS taxa_telemedicina
FROM v360 GROUP BY ALL""")
def kpi_demography(spark, sf):
    places = B.hospitals(spark, sf).select("id_hospital", "regiao")
    people = B.patients(spark, sf).select("id_paciente", "idade", "sexo", "convenio")
    return kpi.demography(integrity.left_join_optional(
        patient_parts(spark, sf).join(places, "id_hospital"), "id_paciente", people, "id_paciente", ["id_hospital"]))


@query("metrics_by_group", f"""
WITH {B.V}
SELECT especialidade, count(*) AS total_consultas, avg(tempo_espera_minutos) AS tempo_espera_medio,
       CAST(count(CASE WHEN status = 'finalizada' THEN 1 END) AS DOUBLE) / count(*) * 100.0
         AS taxa_conclusao_pct
FROM v GROUP BY especialidade""")
def metrics_by_group(spark, sf):
    sums = kpi.partials(B.visits(spark, sf, codes=False), ["id_medico"])
    return kpi.by_specialty(sums.join(B.specialties(spark, sf), "id_medico")).orderBy(F.desc("tempo_espera_medio"))


@query("daily_briefing_metrics", f"""
WITH {B.V}
SELECT count(*) AS total_consultas, count(DISTINCT id_hospital) AS hospitais_ativos,
       count(DISTINCT especialidade) AS especialidades,
       avg(tempo_espera_minutos) AS tempo_espera_medio,
       CAST(count(CASE WHEN status = 'finalizada' THEN 1 END) AS DOUBLE) / count(*) * 100.0
         AS taxa_conclusao
FROM v""")
def daily_briefing_metrics(spark, sf):
    return kpi.daily_totals(day_parts(spark, sf))


@query("metrics_by_hospital", f"""
WITH {B.V}, {B.H}
SELECT nome_hospital, cidade, count(*) AS total_consultas,
       avg(tempo_espera_minutos) AS tempo_espera_medio,
       count(DISTINCT especialidade) AS especialidades_ativas
FROM v JOIN h ON h.id_hospital = v.id_hospital
GROUP BY nome_hospital, cidade
ORDER BY total_consultas DESC, nome_hospital, cidade LIMIT 5""")
def metrics_by_hospital(spark, sf):
    return busiest(spark, sf).drop("espera_soma", "espera_n")


def busiest(spark, sf):
    parts = kpi.partials(B.lines(spark, sf), ["id_hospital", "id_medico"])
    return kpi.busiest_hospitals(parts.join(B.specialties(spark, sf), "id_medico"), B.hospitals(spark, sf))


@query("narrative_hospital", f"""
WITH {B.V}, {B.H},
t AS (SELECT nome_hospital, cidade, count(*) AS n, CAST(sum(tempo_espera_minutos) AS BIGINT) AS s,
             count(DISTINCT especialidade) AS e
      FROM v JOIN h ON h.id_hospital = v.id_hospital GROUP BY nome_hospital, cidade
      ORDER BY n DESC, nome_hospital, cidade LIMIT 5),
u AS (SELECT *, (20 * s + n) // (2 * n) AS u FROM t)
SELECT nome_hospital, cidade, nome_hospital || ' (' || cidade || '): ' || n || ' consultas em ' || e
       || ' especialidades, espera media de ' || u // 10 || '.' || u % 10 || ' min.' AS resumo FROM u""")
def narrative_hospital(spark, sf):
    return narrative.by_hospital(busiest(spark, sf))


@query("top_codes_by_specialty", f"""
WITH {B.V},
c AS (SELECT especialidade, cid_10, count(*) AS total FROM v
      WHERE status = 'finalizada' AND cid_10 IS NOT NULL GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY especialidade ORDER BY total DESC, cid_10) AS posicao
      FROM c)
SELECT * FROM n WHERE posicao <= 3""")
def top_codes_by_specialty(spark, sf):
    parts = kpi.partials(B.visits(spark, sf, codes=False), ["id_medico"])
    return kpi.top_codes(parts.join(B.codes(spark, sf), "id_medico"))


@query("label_distribution", """
SELECT o_orderpriority AS prioridade, count(*) AS total,
       count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM orders) AS percentual
FROM orders GROUP BY o_orderpriority""")
def label_distribution(spark, sf):
    orders = B.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("prioridade"))
    return shares.label_shares(orders, ["prioridade"])


@query("limited_distribution", """
WITH f AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 100)
SELECT o_orderpriority AS prioridade, count(*) AS total,
       count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM f) AS percentual
FROM f GROUP BY o_orderpriority""")
def limited_distribution(spark, sf):
    orders = B.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("prioridade"))
    return shares.label_shares(ranking.first_n(orders, 100, ["o_orderkey"]), ["prioridade"])


@query("load_per_capacity", f"""
WITH {B.V}, {B.H}
SELECT h.id_hospital, regiao, estado, count(*) AS total_consultas,
       CAST(count(*) AS DOUBLE) / qtd_leitos AS consultas_por_leito,
       CAST(count(*) AS DOUBLE) / qtd_medicos AS consultas_por_medico
FROM v JOIN h ON h.id_hospital = v.id_hospital
GROUP BY h.id_hospital, regiao, estado, qtd_leitos, qtd_medicos""")
def load_per_capacity(spark, sf):
    return kpi.load_per_capacity(B.lines(spark, sf), B.hospitals(spark, sf))


@query("load_by_region", f"""
WITH {B.V}, {B.H},
n AS (SELECT id_hospital, count(*) AS total FROM v GROUP BY id_hospital)
SELECT regiao, estado, CAST(sum(total) AS BIGINT) AS total_consultas,
       CAST(sum(total) AS DOUBLE) / CAST(sum(qtd_leitos) AS DOUBLE) AS consultas_por_leito,
       CAST(sum(total) AS DOUBLE) / CAST(sum(qtd_medicos) AS DOUBLE) AS consultas_por_medico
FROM n JOIN h ON h.id_hospital = n.id_hospital GROUP BY regiao, estado""")
def load_by_region(spark, sf):
    return kpi.load_by_region(B.lines(spark, sf), B.hospitals(spark, sf))


@query("telemedicine_ratio", f"""
WITH {B.V}
SELECT especialidade, count(*) AS total_consultas,
       CAST(count(CASE WHEN modalidade = 'telemedicina' THEN 1 END) AS DOUBLE) / count(*)
         AS taxa_telemedicina
FROM v GROUP BY especialidade""")
def telemedicine_ratio(spark, sf):
    return kpi.telemedicine_ratio(_parts_with_specialty(spark, sf))


@query("age_plan_hospital", f"""
WITH {B.V360}
SELECT {B.AGE_BAND_SQL} AS faixa_etaria, convenio, id_hospital, count(*) AS total_consultas,
       count(DISTINCT id_paciente) AS pacientes
FROM v360 WHERE id_paciente IS NOT NULL GROUP BY ALL""")
def age_plan_hospital(spark, sf):
    known = B.table(spark, sf, "supplier").select("s_suppkey")
    parts = integrity.covered(patient_parts(spark, sf), "id_hospital", known, "s_suppkey")
    return kpi.age_plan_hospital(parts, B.patients(spark, sf))


@query("filtered_cohort", f"""
WITH {B.P}
SELECT id_paciente, nome_paciente, idade FROM p WHERE convenio = 'MACHINERY' AND idade > 60""")
def filtered_cohort(spark, sf):
    return kpi.cohort(B.patients(spark, sf), "MACHINERY", 60).select(
        "id_paciente", "nome_paciente", "idade")


@query("reviews_by_channel_hospital", f"""
WITH {B.V}, {B.R}
SELECT canal_avaliacao, id_hospital, count(*) AS total
FROM r JOIN v ON v.id_consulta = r.id_consulta GROUP BY ALL""")
def reviews_by_channel_hospital(spark, sf):
    places = B.lines(spark, sf).select("id_consulta", "id_hospital")
    joined = B.reviews(spark, sf).select("id_consulta", "canal_avaliacao").join(places, "id_consulta")
    return kpi.counts_by(joined, ["canal_avaliacao", "id_hospital"])


def _rated(spark, sf):
    scored = B.review_sentiment(spark, sf).withColumn("nota", X.sentiment_score(F.col("sentimento")))
    waits = B.lines(spark, sf).select("id_consulta", "tempo_espera_minutos")
    return waits.join(scored.select("id_consulta", "sentimento", "nota"), "id_consulta")


WAIT_BAND_SQL = """CASE WHEN tempo_espera_minutos < 20 THEN '<20'
     WHEN tempo_espera_minutos <= 30 THEN '20..30' ELSE '>30' END"""


@query("sentiment_by_wait_band", f"""
WITH {B.V}, {B.RS},
b AS (SELECT {WAIT_BAND_SQL} AS faixa_espera, sentimento
      FROM v JOIN rs ON rs.id_consulta = v.id_consulta),
c AS (SELECT faixa_espera, sentimento, count(*) AS total FROM b GROUP BY ALL)
SELECT *, total * CAST(100.0 AS DOUBLE) / CAST(sum(total) OVER (PARTITION BY faixa_espera) AS DOUBLE)
       AS percentual FROM c""")
def sentiment_by_wait_band(spark, sf):
    return kpi.sentiment_by_wait_band(_rated(spark, sf))


@query("corr_wait_sentiment", f"""
WITH {B.V}, {B.RS}
SELECT round(corr(tempo_espera_minutos, nota), 6) AS correlacao
FROM v JOIN rs ON rs.id_consulta = v.id_consulta""")
def corr_wait_sentiment(spark, sf):
    return kpi.wait_sentiment_correlation(_rated(spark, sf)).select(
        F.round("correlacao", 6).alias("correlacao"))


@query("sentiment_by_anon", f"""
WITH {B.RS},
c AS (SELECT avaliacao_anonima, sentimento, count(*) AS total FROM rs GROUP BY ALL)
SELECT *, total * CAST(100.0 AS DOUBLE)
       / CAST(sum(total) OVER (PARTITION BY avaliacao_anonima) AS DOUBLE) AS percentual FROM c""")
def sentiment_by_anon(spark, sf):
    return shares.label_shares(B.review_sentiment(spark, sf), ["sentimento"], ["avaliacao_anonima"])


@query("sentiment_by_delay", f"""
WITH {B.RS},
b AS (SELECT CASE WHEN tempo_para_avaliar_min < 120 THEN 'ate 2h'
                  WHEN tempo_para_avaliar_min < 1440 THEN '2h a 24h'
                  WHEN tempo_para_avaliar_min < 7200 THEN '1 a 5 dias'
                  ELSE 'mais de 5 dias' END AS faixa_resposta, sentimento FROM rs),
c AS (SELECT faixa_resposta, sentimento, count(*) AS total FROM b GROUP BY ALL)
SELECT *, total * CAST(100.0 AS DOUBLE)
       / CAST(sum(total) OVER (PARTITION BY faixa_resposta) AS DOUBLE) AS percentual FROM c""")
def sentiment_by_delay(spark, sf):
    banded = B.review_sentiment(spark, sf).withColumn(
        "faixa_resposta", C.delay_band(F.col("tempo_para_avaliar_min")))
    return shares.label_shares(banded, ["sentimento"], ["faixa_resposta"])


@query("gold_kpis", f"""
WITH {B.V}, {B.H}, {B.RS},
n AS (SELECT id_consulta, sum(nota) AS s, count(nota) AS c FROM rs GROUP BY id_consulta)
SELECT v.id_hospital, nome_hospital, count(*) AS volume,
       avg(tempo_espera_minutos) AS tempo_espera_medio,
       CAST(sum(s) AS DOUBLE) / CAST(sum(c) AS DOUBLE) AS sentimento_medio
FROM v JOIN h ON h.id_hospital = v.id_hospital LEFT JOIN n ON n.id_consulta = v.id_consulta
GROUP BY v.id_hospital, nome_hospital""")
def gold_kpis(spark, sf):
    scores = kpi.scores_by_visit(B.review_sentiment(spark, sf))
    return kpi.hospital_scores(B.lines(spark, sf), scores, B.hospitals(spark, sf))


@query("metrics_text", f"""
WITH {B.V},
w AS (SELECT especialidade, count(*) AS n, CAST(sum(tempo_espera_minutos) AS BIGINT) AS s
      FROM v GROUP BY especialidade),
t AS (SELECT especialidade, n, (20 * s + n) // (2 * n) AS u FROM w)
SELECT string_agg(especialidade || ': ' || n || ' consultas, espera media ' || u // 10 || '.'
                  || u % 10 || ' min', '. ' ORDER BY especialidade) AS texto_metricas FROM t""")
def metrics_text(spark, sf):
    return narrative.metrics_text(_parts_with_specialty(spark, sf))


@query("briefing_text", f"""
WITH {B.V},
w AS (SELECT count(*) AS n, count(DISTINCT id_hospital) AS h, count(DISTINCT especialidade) AS e,
             CAST(sum(tempo_espera_minutos) AS BIGINT) AS s,
             count(CASE WHEN status = 'finalizada' THEN 1 END) AS f FROM v),
t AS (SELECT *, (20 * s + n) // (2 * n) AS u, (2000 * f + n) // (2 * n) AS q FROM w)
SELECT 'Operacao do dia: ' || n || ' consultas em ' || h || ' hospitais ativos cobrindo ' || e
       || ' especialidades. Tempo medio de espera: ' || u // 10 || '.' || u % 10
       || ' minutos. Taxa de conclusao: ' || q // 10 || '.' || q % 10 || '%.' AS briefing FROM t""")
def briefing_text(spark, sf):
    return narrative.briefing_text(day_parts(spark, sf))


@query("narrative_overall", f"""
WITH {B.V},
w AS (SELECT especialidade, count(*) AS n, CAST(sum(tempo_espera_minutos) AS BIGINT) AS s
      FROM v GROUP BY especialidade),
t AS (SELECT especialidade, CAST(s AS DOUBLE) / n AS m, (20 * s + n) // (2 * n) AS u FROM w),
x AS (SELECT especialidade, u // 10 || '.' || u % 10 AS z FROM t ORDER BY m DESC, especialidade LIMIT 1),
y AS (SELECT especialidade, u // 10 || '.' || u % 10 AS z FROM t ORDER BY m, especialidade LIMIT 1)
SELECT 'Principal gargalo: ' || x.especialidade || ', com espera media de ' || x.z
       || ' min. Melhor desempenho: ' || y.especialidade || ', com ' || y.z || ' min.' AS analise
FROM x, y""")
def narrative_overall(spark, sf):
    return narrative.overall(_parts_with_specialty(spark, sf))


@query("narrative_by_group", f"""
WITH {B.V},
w AS (SELECT id_hospital, count(*) AS n, CAST(sum(tempo_espera_minutos) AS BIGINT) AS s
      FROM v GROUP BY id_hospital),
t AS (SELECT *, CAST(s AS DOUBLE) / n AS m, (20 * s + n) // (2 * n) AS u FROM w)
SELECT id_hospital, id_hospital || ' teve ' || n || ' consultas com espera media de ' || u // 10
       || '.' || u % 10 || ' min: '
       || CASE WHEN m < 20 THEN 'manter a escala atual'
               WHEN m < 25 THEN 'abrir horarios extras nos dias de pico'
               WHEN m < 30 THEN 'redistribuir a agenda entre as unidades'
               ELSE 'reforcar a equipe com urgencia' END || '.' AS recomendacao
FROM t""")
def narrative_by_group(spark, sf):
    sums = kpi.partials(B.lines(spark, sf), ["id_hospital"])
    return narrative.by_group(sums, "id_hospital")


@query("merged_correlation", """
SELECT l_suppkey AS id_hospital, count(*) AS n, round(corr(l_quantity, l_discount), 9) AS correlacao,
       round(stddev_pop(l_quantity), 9) AS desvio
FROM lineitem GROUP BY l_suppkey""")
def merged_correlation(spark, sf):
    """Wait and rate per hospital, from stored rows per hospital and mode."""
    parts = moments.partial_moments(B.table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"],
                                    "l_quantity", "l_discount")
    return moments.merged(parts, ["l_suppkey"]).select(
        F.col("l_suppkey").alias("id_hospital"), "n", F.round(moments.correlation(), 9).alias("correlacao"),
        F.round(moments.deviation("m2_x"), 9).alias("desvio"))
