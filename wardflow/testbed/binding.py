"""The reference-shaped frames over the driver's tables, for Spark and as oracle SQL.

Each frame reads only the columns it needs; joins are left out where the caller does not
use their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.functions import columns as C
from wardflow.functions import text as X
from wardflow.operators.spread import spread_files

AS_OF = "2024-01-31"

# Terms that occur in the test texts. The weights are multiples of 0.25, so sums are exact.
INSULT = {"insult": dict.fromkeys(("trash", "scum", "idiot", "moron"), 1.0),
          "scorn": dict.fromkeys(("worthless", "pathetic", "disgusting"), 1.0)}
TOXIC = ("trash", "idiot", "scum", "clown", "worthless", "moron", "pathetic", "loser",
         "disgusting", "stupid")
PRAISE = ("avec", "nicht", "pero", "this work", "from")
PRIORITY = {"urgente": dict.fromkeys(("trash", "scum", "idiot", "moron", "clown"), 60.0),
            "alta": {"worthless": 40.0, "pathetic": 40.0, "with": 1.5, "por": 1.25},
            "media": {"this": 2.0, "und": 0.75, "une": 2.5, "of the": 1.5, "de la": 1.25},
            "eletiva": {"pour": 1.0, "dans": 1.0}}
RISK = {"baixo_risco": {"the": 0.5, "der": 1.0},
        "medio_risco": {"and": 1.0, "la": 0.75, "das": 1.5},
        "alto_risco": {**dict.fromkeys(TOXIC, 50.0), "that": 1.0}}
THEME = {"tempo_de_espera": {"was": 2.0, "est": 2.0, "in the": 1.25},
         "qualidade_medica": {"are": 2.5, "ist": 2.0},
         "atendimento_recepcao": {"for": 1.0, "sur": 2.0},
         "infraestrutura": {"by": 1.5, "los": 0.75}}
CRITICALITY = {"problema_critico": dict.fromkeys(TOXIC, 30.0),
               "problema_atencao": {"not": 1.0, "pas": 1.0, "nicht": 1.0, "no": 1.0},
               "destaque_positivo": {"it": 0.5, "es": 0.5}}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The visit fact without the columns that come from orders.

    Every line has its order (``fk_orphans`` counts the lines without one), so a query that
    needs no patient and no status gets the same rows from here, without joining the two facts.
    """
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id_consulta"),
        F.col("l_suppkey").alias("id_hospital"),
        F.col("l_partkey").alias("id_medico"),
        F.col("l_quantity").cast("int").alias("tempo_espera_minutos"),
        C.by_value(F.col("l_returnflag"), {"N": "presencial", "R": "retorno"}, "telemedicina")
        .alias("modalidade"),
    )


def visits(spark: SparkSession, folder: str, codes: bool = True) -> DataFrame:
    """The visit fact at line grain. ``codes`` brings specialty and diagnosis from part."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id_consulta"),
        patient_key().alias("id_paciente"),
        status().alias("status"),
    )
    joined = lines(spark, folder).join(orders, "id_consulta")
    if not codes:
        return joined
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id_medico"), F.col("p_type").alias("especialidade"),
        F.col("p_brand"), F.col("p_name"))
    finished = F.col("status") == "finalizada"
    return joined.join(parts, "id_medico").select(
        *joined.columns, "especialidade",
        F.when(finished, F.col("p_brand")).alias("cid_10"),
        F.when(finished, F.col("p_name")).alias("diagnostico_descricao"),
    )


def specialties(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id_medico"), F.col("p_type").alias("especialidade"))


def doctors(spark: SparkSession, folder: str) -> DataFrame:
    """One row per doctor id: name, licence, specialty."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id_medico"), F.col("p_name").alias("nome_medico"),
        F.col("p_brand").alias("crm"), F.col("p_type").alias("especialidade"))


def codes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per doctor id: specialty, and the code and diagnosis of finished visits."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id_medico"), F.col("p_type").alias("especialidade"),
        F.col("p_brand").alias("cid_10"), F.col("p_name").alias("diagnostico_descricao"))


def patient_key():
    """The patient is missing for every thirteenth visit."""
    return F.when(C.spread(F.col("o_orderkey"), 1, 13) != 5, F.col("o_custkey"))


def status():
    return C.by_value(F.col("o_orderstatus"), {"F": "finalizada", "P": "cancelada"}, "em_andamento")


V = """
v AS (
  SELECT l_orderkey AS id_consulta, l_suppkey AS id_hospital, l_partkey AS id_medico,
         CAST(l_quantity AS INTEGER) AS tempo_espera_minutos,
         CASE l_returnflag WHEN 'N' THEN 'presencial' WHEN 'R' THEN 'retorno'
              ELSE 'telemedicina' END AS modalidade,
         CASE WHEN o_orderkey % 13 <> 5 THEN o_custkey END AS id_paciente,
         CASE o_orderstatus WHEN 'F' THEN 'finalizada' WHEN 'P' THEN 'cancelada'
              ELSE 'em_andamento' END AS status,
         p_type AS especialidade,
         CASE WHEN o_orderstatus = 'F' THEN p_brand END AS cid_10,
         CASE WHEN o_orderstatus = 'F' THEN p_name END AS diagnostico_descricao
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
)"""


def hospitals(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id_hospital"),
        F.col("s_name").alias("nome_hospital"),
        F.col("n_name").alias("cidade"),
        F.col("n_name").alias("estado"),
        F.col("r_name").alias("regiao"),
        F.concat(F.lit("Clinica "), F.lower("r_name")).alias("especialidade"),
        (C.spread(F.col("s_suppkey"), 1, 12) + 5).alias("qtd_leitos"),
        (C.spread(F.col("s_suppkey"), 1, 7) + 2).alias("qtd_medicos"),
    )


H = """
h AS (
  SELECT s_suppkey AS id_hospital, s_name AS nome_hospital, n_name AS cidade, n_name AS estado,
         r_name AS regiao, 'Clinica ' || lower(r_name) AS especialidade_hospital, s_suppkey % 12 + 5 AS qtd_leitos, s_suppkey % 7 + 2 AS qtd_medicos
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
)"""


def patients(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1931-05-09").cast("date"), C.spread(key, 41, 30011).cast("int"))
    return table(spark, folder, "customer").select(
        key.alias("id_paciente"),
        F.col("c_name").alias("nome_paciente"),
        born.alias("data_nascimento"),
        C.whole_years(born, as_of).alias("idade"),
        C.by_value(C.spread(key, 1, 2), {0: "M"}, "F").alias("sexo"),
        F.col("c_mktsegment").alias("convenio"),
    )


P = f"""
p0 AS (
  SELECT c_custkey AS id_paciente, c_name AS nome_paciente, c_mktsegment AS convenio,
         DATE '1931-05-09' + CAST((c_custkey * 41) % 30011 AS INTEGER) AS data_nascimento,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sexo
  FROM customer
),
p AS (
  SELECT *, CAST(floor(datediff('day', data_nascimento, DATE '{AS_OF}') / 365.25) AS INTEGER)
            AS idade
  FROM p0
)"""

AGE_BAND_SQL = """CASE WHEN idade < 18 THEN '0-17' WHEN idade < 35 THEN '18-34'
     WHEN idade < 50 THEN '35-49' WHEN idade < 65 THEN '50-64' WHEN idade IS NOT NULL THEN '65+' END"""

V360 = f"""{V}, {H}, {P},
v360 AS (
  SELECT v.*, h.nome_hospital, h.cidade, h.estado, h.regiao, h.especialidade_hospital,
         h.qtd_leitos, h.qtd_medicos,
         p.nome_paciente, p.data_nascimento, p.idade, p.sexo, p.convenio
  FROM v JOIN h ON h.id_hospital = v.id_hospital LEFT JOIN p ON p.id_paciente = v.id_paciente
)"""


def number_of_documents(spark: SparkSession, folder: str) -> Column:
    """The count as a scalar subquery: it runs with the query that uses it."""
    return table(spark, folder, "documents").agg(F.count("*")).scalar()


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Review events with the id of their text; the texts stay in ``documents``."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id_avaliacao"),
        F.col("event_id").alias("id_consulta"),
        F.col("user_id").alias("id_paciente"),
        F.col("event_type").alias("canal_avaliacao"),
        F.floor(F.col("value") * 24).cast("int").alias("tempo_para_avaliar_min"),
        (k < 15).alias("avaliacao_anonima"),
        C.spread(F.col("event_id"), 1, number_of_documents(spark, folder)).alias("doc_id"),
        F.col("ts").cast("date").alias("data_avaliacao"),
    )


def with_text_columns(facts: DataFrame, labelled_texts: DataFrame) -> DataFrame:
    """Attach columns computed once per text to the facts that carry the text's id."""
    return facts.join(labelled_texts, "doc_id")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_files(table(spark, folder, "documents").select("doc_id", "text"))


def review_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with the sentiment of their text, labelled once per text and stored."""
    texts = documents(spark, folder).select(
        "doc_id", X.sentiment(F.col("text"), PRAISE, TOXIC).alias("sentimento"))
    return with_text_columns(reviews(spark, folder), scratch.materialise(texts, "sentiment"))


def with_doc(spark: SparkSession, folder: str, facts: DataFrame) -> DataFrame:
    """Visits with the id of the text that describes their complaint."""
    return facts.withColumn(
        "doc_id", C.spread(F.col("id_consulta"), 1, number_of_documents(spark, folder)))


# ---- oracle SQL for the text operators ----

def fold_sql(column: str) -> str:
    plain = f"lower(translate({column}, '{X.TEXT_ACCENTS}', '{X.TEXT_PLAIN}'))"
    return f"trim(regexp_replace({plain}, '[^a-z0-9]+', ' ', 'g'))"


def score_sql(folded: str, terms: dict[str, float]) -> str:
    parts = [f"{w} * len(regexp_extract_all({folded}, '\\b(?:{t})\\b'))" for t, w in terms.items()]
    return " + ".join(parts) or "0.0"


def classify_sql(source: str, key: str, text: str, lexicon, default: str, label: str,
                 name: str) -> str:
    """CTE ``name``(key, label): the scores per label side by side, then the first greatest."""
    scores = ", ".join(f"CAST({score_sql('f', terms)} AS DOUBLE) AS s{i}"
                       for i, terms in enumerate(lexicon.values()))
    n = len(lexicon)
    whens = " ".join(
        f"WHEN s{i} > 0" + "".join(f" AND s{i} >= s{j}" for j in range(n) if j != i)
        + f" THEN '{lab}'" for i, lab in enumerate(lexicon))
    return (f"{name} AS (SELECT {key}, CASE {whens} ELSE '{default}' END AS {label} FROM ("
            f"SELECT {key}, {scores} FROM (SELECT {key}, {fold_sql(text)} AS f FROM {source})))")


def sentiment_case_sql(folded: str, positive, negative) -> str:
    good = f"regexp_matches({folded}, '\\b(?:{'|'.join(positive)})\\b')"
    bad = f"regexp_matches({folded}, '\\b(?:{'|'.join(negative)})\\b')"
    return (f"CASE WHEN {good} AND {bad} THEN 'mixed' WHEN {good} THEN 'positive' "
            f"WHEN {bad} THEN 'negative' ELSE 'neutral' END")


R = """
r AS (
  SELECT event_id AS id_avaliacao, event_id AS id_consulta, user_id AS id_paciente,
         event_type AS canal_avaliacao, CAST(floor(value * 24) AS INTEGER) AS tempo_para_avaliar_min,
         CAST(ts AS DATE) AS data_avaliacao,
         CAST(json_extract_string(props, '$.k') AS INTEGER) < 15 AS avaliacao_anonima,
         event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM events
)"""

RS = f"""{R},
ds AS (SELECT doc_id, {sentiment_case_sql('f', PRAISE, TOXIC)} AS sentimento
       FROM (SELECT doc_id, {fold_sql('text')} AS f FROM documents)),
rs AS (SELECT r.*, ds.sentimento,
              CASE sentimento WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END AS nota
       FROM r JOIN ds ON ds.doc_id = r.doc_id)"""

DP = classify_sql("documents", "doc_id", "text", PRIORITY, "eletiva", "prioridade", "dp")
DR = classify_sql("documents", "doc_id", "text", RISK, "baixo_risco", "risco", "dr")

VL = f"""{V}, {DP}, {DR},
vl AS (SELECT v.*, dp.prioridade, dr.risco FROM v
       JOIN dp ON dp.doc_id = v.id_consulta % (SELECT count(*) FROM documents)
       JOIN dr ON dr.doc_id = dp.doc_id)"""
