"""Text queries over documents, conversations and embeddings, and over labelled visits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.functions import lexicons
from wardflow.functions import text as X
from wardflow.operators import enrich, label_store, phrases, shares, summarize, weights
from wardflow.operators.spread import spread_files
from wardflow.plans import kpi, views
from wardflow.testbed import binding as B
from wardflow.testbed.registry import query


def _documents(spark, sf):
    return B.documents(spark, sf)


CLASSIFY_SQL = f"""
WITH {B.classify_sql("documents", "doc_id", "text", B.INSULT, "other", "label", "c")}
SELECT doc_id, label FROM c"""


@query("classify_text", CLASSIFY_SQL)
def classify_text(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", X.classify(F.col("text"), B.INSULT, "other").alias("label"))


@query("classify_text_join", f"""
WITH {B.classify_sql("documents", "doc_id", "text", B.PRIORITY, "eletiva", "label", "c")}
SELECT doc_id, label FROM c""")
def classify_text_join(spark, sf):
    lexicon = spark.createDataFrame(
        [(i, label, term, weight) for i, (label, terms) in enumerate(B.PRIORITY.items())
         for term, weight in terms.items()],
        "position int, label string, term string, weight double")
    return phrases.classify_by_lexicon(_documents(spark, sf), "doc_id", "text", lexicon, "eletiva")


# A lexicon learnt from the labels; then the texts by it.
LEARNT_LEAST = 2.0  # standard errors: the small tables have few labelled texts
LEARNT_SQL = f"""
lt AS (SELECT CAST(toxic AS VARCHAR) AS label, list_distinct(list_filter(string_split({B.fold_sql("text")}, ' '),
              lambda w: w <> '')) AS terms FROM documents JOIN labels ON labels.doc_id = documents.doc_id
       WHERE toxic IS NOT NULL AND text IS NOT NULL),
ls AS (SELECT label, count(*) AS size, sum(count(*)) OVER () AS whole,
              row_number() OVER (ORDER BY label) - 1 AS position FROM lt GROUP BY label),
lc AS (SELECT label, unnest(terms) AS term FROM lt),
ln AS (SELECT term, label, count(*) AS n FROM lc GROUP BY term, label),
lo AS (SELECT term, sum(n) AS total FROM ln GROUP BY term),
le AS (SELECT ls.label, position, lo.term, coalesce(n, 0) AS n, total - coalesce(n, 0) AS o, size, whole - size AS rest
       FROM lo CROSS JOIN ls LEFT JOIN ln ON ln.term = lo.term AND ln.label = ls.label),
lw AS (SELECT *, ln((n + {weights.PRIOR}) / (size - n + {weights.PRIOR})) - ln((o + {weights.PRIOR}) / (rest - o + {weights.PRIOR})) AS w,
              sqrt(1 / (n + {weights.PRIOR}) + 1 / (o + {weights.PRIOR})) AS e
       FROM (SELECT label, position, term, CAST(n AS DOUBLE) AS n, CAST(o AS DOUBLE) AS o, CAST(size AS DOUBLE) AS size,
                    CAST(rest AS DOUBLE) AS rest FROM le)),
lx AS (SELECT CAST(position AS INTEGER) AS position, label, term, CAST(round(w, 6) AS DECIMAL(18, 6)) AS weight,
              CAST(n AS BIGINT) AS n FROM lw WHERE abs(w) >= {LEARNT_LEAST} * e)"""


def _learnt(spark, sf):
    marked = B.table(spark, sf, "labels").select("doc_id", "toxic")
    return weights.learn(_documents(spark, sf).join(marked, "doc_id"), "text", "toxic", least=LEARNT_LEAST)


@query("learnt_lexicon", f"WITH {LEARNT_SQL} SELECT * FROM lx")
def learnt_lexicon(spark, sf):
    return _learnt(spark, sf)


@query("classify_learnt", f"""
WITH {LEARNT_SQL},
t AS (SELECT doc_id, unnest(string_split({B.fold_sql("text")}, ' ')) AS term FROM documents),
s AS (SELECT doc_id, label, sum(weight) AS score, min(position) AS position
      FROM t JOIN lx ON lx.term = t.term GROUP BY doc_id, label),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, position) AS k FROM s)
SELECT d.doc_id, CASE WHEN score > 0 THEN label ELSE '0' END AS label
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND k = 1""")
def classify_learnt(spark, sf):
    return phrases.classify_by_lexicon(_documents(spark, sf), "doc_id", "text", _learnt(spark, sf), "0")


@query("labels_incremental", f"""
WITH a AS (SELECT 'conversa' AS origem, conv_id AS id, turn AS parte, text FROM conversations
           UNION ALL SELECT 'documento', doc_id, 0, text FROM documents),
k AS (SELECT row_number() OVER () AS doc, * FROM a),
{B.classify_sql("k", "doc", "text", B.PRIORITY, "eletiva", "prioridade", "kp")},
{B.classify_sql("k", "doc", "text", B.RISK, "baixo_risco", "risco", "kr")}
SELECT origem, id, parte, prioridade, risco FROM k JOIN kp ON kp.doc = k.doc JOIN kr ON kr.doc = k.doc""")
def labels_incremental(spark, sf):
    """Two runs over a store of labels: the second labels only the texts that the first has not."""
    root = scratch.new_path(spark, "rotulos")
    turns = spread_files(B.table(spark, sf, "conversations")).select(
        F.lit("conversa").alias("origem"), F.col("conv_id").alias("id"), F.col("turn").alias("parte"), "text")
    texts = _documents(spark, sf).select(
        F.lit("documento").alias("origem"), F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("parte"), "text")
    lexicons = {"prioridade": (B.PRIORITY, "eletiva"), "risco": (B.RISK, "baixo_risco")}
    label_store.labelled_by_rules(turns, "text", root, lexicons)
    return label_store.labelled_by_rules(turns.unionByName(texts), "text", root, lexicons, keep_text=False)


@query("sentiment", f"""
SELECT doc_id, {B.sentiment_case_sql("f", B.PRAISE, B.TOXIC)} AS sentimento
FROM (SELECT doc_id, {B.fold_sql("text")} AS f FROM documents)""")
def sentiment(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", X.sentiment(F.col("text"), B.PRAISE, B.TOXIC).alias("sentimento"))


@query("sentiment_theme", f"""
WITH {B.classify_sql("documents", "doc_id", "text", B.THEME, "outros", "tema", "t")}
SELECT t.doc_id, tema, {B.sentiment_case_sql("f", B.PRAISE, B.TOXIC)} AS sentimento
FROM t JOIN (SELECT doc_id, {B.fold_sql("text")} AS f FROM documents) d ON d.doc_id = t.doc_id""")
def sentiment_theme(spark, sf):
    labels = X.label_all(F.col("text"), {"tema": X.class_rule(B.THEME, "outros"),
                                         "sentimento": X.sentiment_rule(B.PRAISE, B.TOXIC)})
    return views.with_labels(_documents(spark, sf), labels).drop("text")


@query("reviews_by_theme", f"""
WITH {B.R}, {B.classify_sql("documents", "doc_id", "text", B.THEME, "outros", "tema", "t")}
SELECT tema, count(*) AS total FROM r JOIN t ON t.doc_id = r.doc_id GROUP BY tema""")
def reviews_by_theme(spark, sf):
    themes = _documents(spark, sf).select(
        "doc_id", X.classify(F.col("text"), B.THEME, "outros").alias("tema"))
    return kpi.counts_by(B.with_text_columns(B.reviews(spark, sf), themes), ["tema"])


@query("sentiment_distribution", f"""
WITH {B.RS}
SELECT sentimento, count(*) AS total,
       count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM rs) AS percentual
FROM rs GROUP BY sentimento""")
def sentiment_distribution(spark, sf):
    return shares.label_shares(B.review_sentiment(spark, sf), ["sentimento"])


@query("net_score", f"""
WITH {B.RS},
c AS (SELECT count(*) AS n, count(CASE WHEN sentimento = 'positive' THEN 1 END) AS p,
             count(CASE WHEN sentimento = 'negative' THEN 1 END) AS q FROM rs)
SELECT n AS total, p * CAST(100.0 AS DOUBLE) / n - q * CAST(100.0 AS DOUBLE) / n AS saldo FROM c""")
def net_score(spark, sf):
    return shares.net_score(B.review_sentiment(spark, sf), "sentimento")


# The same fields for the oracle, in the plain form without possessive matching.
FIELDS = {"email": X.EMAIL, "telefone": X.PHONE_US, "ip": X.IPV4}
EMAIL_SQL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_SQL = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
IP_SQL = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"


def _first_sql(pattern: str, name: str) -> str:
    return f"nullif(regexp_extract(text, '{pattern}'), '') AS {name}"


FIELDS_SQL = ", ".join([_first_sql(EMAIL_SQL, "email"), _first_sql(PHONE_SQL, "telefone"),
                        _first_sql(IP_SQL, "ip")])


@query("extract_fields", f"SELECT doc_id, {FIELDS_SQL} FROM documents")
def extract_fields(spark, sf):
    found = _documents(spark, sf).select(
        "doc_id", X.extract_fields(F.col("text"), FIELDS).alias("campos"))
    return found.select("doc_id", "campos.*")


@query("risk_details", f"""
WITH {B.DR}
SELECT d.doc_id, risco AS nivel_risco, email, telefone, ip
FROM dr JOIN (SELECT doc_id, {FIELDS_SQL} FROM documents) d ON d.doc_id = dr.doc_id""")
def risk_details(spark, sf):
    labelled = views.risk_details(_documents(spark, sf), FIELDS, "text", B.RISK, "baixo_risco")
    return labelled.select("doc_id", "nivel_risco", "detalhes.*")


CPF_SQL = r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"
CNS_SQL = r"700 [0-9]{4} [0-9]{4} [0-9]{3}"
RG_SQL = r"[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9]"
PHONE_BR_SQL = r"\([0-9]{2}\) ?9?[0-9]{4}-[0-9]{4}"
MASKED_SQL = "text"
for _pattern in (EMAIL_SQL, CPF_SQL, CNS_SQL, RG_SQL, PHONE_SQL, PHONE_BR_SQL, IP_SQL):
    MASKED_SQL = f"regexp_replace({MASKED_SQL}, '{_pattern}', '[MASKED]', 'g')"


@query("mask_pii", f"""
SELECT doc_id, md5({MASKED_SQL}) AS texto_md5, text <> {MASKED_SQL} AS alterado FROM documents""")
def mask_pii(spark, sf):
    entities = ["email", "national_id", "phone", "ip"]
    masked = _documents(spark, sf).withColumn("mascarado", X.mask(F.col("text"), entities))
    return masked.select("doc_id", F.md5("mascarado").alias("texto_md5"),
                         (F.col("text") != F.col("mascarado")).alias("alterado"))


# Words that start many texts, as a list of names.
NAMES = ("The", "And", "La", "Die", "In", "Th", "Of")
PERSON_SQL = (
    "regexp_replace(array_to_string(list_transform(regexp_extract_all(text, '\\p{L}+|[^\\p{L}]+'), lambda t: "
    f"CASE WHEN t IN ({', '.join(repr(n) for n in NAMES)}) THEN '[MASKED]' ELSE t END), ''), "
    "'\\[MASKED\\](?: \\[MASKED\\])+', '[MASKED]', 'g')")


@query("mask_person", f"SELECT doc_id, md5({PERSON_SQL}) AS texto_md5 FROM documents")
def mask_person(spark, sf):
    """Names of a list, whole words, runs of them as one."""
    masked = X.mask(F.col("text"), ["person"], NAMES)
    return _documents(spark, sf).select("doc_id", F.md5(masked).alias("texto_md5"))


# Names of one to five words: the list, and the words that texts marked as complaints begin with.
FIRST_WORDS = r"^\p{L}+(?: \p{L}+){0,4}"
NAMES_SQL = f"""
n AS (SELECT DISTINCT nome FROM (
  SELECT regexp_extract(text, '{FIRST_WORDS}') AS nome FROM documents JOIN labels ON labels.doc_id = documents.doc_id
  WHERE toxic = 1 UNION ALL VALUES {", ".join(f"('{name}')" for name in NAMES)}) WHERE nome <> ''),
w AS (SELECT string_agg(regexp_replace(nome, '(\\p{{L}}+)', chr(1) || '\\1' || chr(2), 'g'), '|'
                        ORDER BY length(nome) DESC, nome) AS one FROM n)"""


@query("mask_person_join", f"""
WITH {NAMES_SQL},
m AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(\\p{{L}}+)', chr(1) || '\\1' || chr(2), 'g'),
                                    '(?:' || one || ')(?: (?:' || one || '))*', '[MASKED]', 'g') AS t FROM documents, w)
SELECT doc_id, md5(replace(replace(t, chr(1), ''), chr(2), '')) AS texto_md5 FROM m""")
def mask_person_join(spark, sf):
    """Names of a table, of one to five words; where they overlap, the first and longest."""
    marked = B.table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    first = _documents(spark, sf).join(marked, "doc_id").select(
        F.regexp_extract("text", FIRST_WORDS, 0).alias("nome"))
    names = first.unionByName(spark.createDataFrame([(n,) for n in NAMES], "nome string"))
    masked = phrases.mask_names(_documents(spark, sf), "doc_id", "text", names, "nome", X.MASK)
    return masked.select("doc_id", F.md5("text").alias("texto_md5"))


def _words_sql(column: str) -> str:
    return (f"list_distinct(list_filter(string_split({B.fold_sql(column)}, ' '), "
            f"lambda w: w <> ''))")


def _jaccard_sql(a: str, b: str) -> str:
    common = f"CAST(len(list_intersect({a}, {b})) AS DOUBLE)"
    union = f"(len({a}) + len({b}) - len(list_intersect({a}, {b})))"
    return f"CASE WHEN {union} > 0 THEN {common} / {union} ELSE 0.0 END"


@query("text_similarity", f"""
WITH w AS (SELECT conv_id, turn, {_words_sql("text")} AS w FROM conversations)
SELECT a.conv_id, a.turn, {_jaccard_sql("a.w", "b.w")} AS similaridade
FROM w a JOIN w b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""")
def text_similarity(spark, sf):
    """Each turn of a conversation against the next one."""
    turns = spread_files(B.table(spark, sf, "conversations").select("conv_id", "turn", "text"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("resposta"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", X.jaccard(F.col("text"), F.col("resposta")).alias("similaridade"))


@query("embedding_similarity", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT a.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS similaridade
FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""")
def embedding_similarity(spark, sf):
    """Each vector against the next id's vector."""
    vectors = B.table(spark, sf, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("seguinte"))
    return vectors.join(following, "vec_id").select(
        "vec_id", F.round(X.cosine(F.col("embedding"), F.col("seguinte")), 6).alias("similaridade"))


@query("similarity_join", f"""
WITH w AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
c AS (SELECT min(w.doc_id) AS ref_id, count(*) AS copias, list_sort(w.w) AS rw
      FROM w JOIN labels ON labels.doc_id = w.doc_id
      WHERE toxic = 1 AND len(w.w) > 0 GROUP BY list_sort(w.w)),
s AS (SELECT doc_id, ref_id, copias, {_jaccard_sql("w", "rw")} AS similaridade FROM w JOIN c ON len(w) > 0)
SELECT * FROM s WHERE similaridade >= 0.6""")
def similarity_join(spark, sf):
    """Texts against the catalogue of texts marked as complaints."""
    # Written, so that its real size decides whether the texts have to be shuffled to meet it.
    marked = scratch.materialise(B.table(spark, sf, "labels").where("toxic = 1").select("doc_id"), "marked")
    catalogue = _documents(spark, sf).join(marked, "doc_id").select(
        F.col("doc_id").alias("ref_id"), F.col("text").alias("ref_text"))
    return phrases.match_phrases(_documents(spark, sf), "doc_id", "text", catalogue, "ref_id",
                                 "ref_text", 0.6)


SUMMARY_WORDS = 40


@query("summarize", f"""
WITH s0 AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\\n]+')) AS raw,
                   generate_subscripts(string_split_regex(text, '[.!?\\n]+'), 1) AS pos FROM documents),
s1 AS (SELECT doc_id, pos, trim(regexp_replace(raw, '[ \\t\\r]+', ' ', 'g')) AS sentence FROM s0),
s2 AS (SELECT *, list_filter(string_split({B.fold_sql("sentence")}, ' '), lambda w: w <> '') AS tokens
       FROM s1),
s3 AS (SELECT *, len(tokens) AS n FROM s2 WHERE len(tokens) > 0),
k AS (SELECT doc_id, pos, unnest(tokens) AS token FROM s3),
f AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, token) AS tf FROM k),
g AS (SELECT doc_id, pos, sum(tf) AS tfs FROM f GROUP BY doc_id, pos),
h AS (SELECT s3.doc_id, s3.pos, sentence, n,
             sum(n) OVER (PARTITION BY s3.doc_id ORDER BY CAST(tfs AS DOUBLE) / n DESC, s3.pos
                          ROWS UNBOUNDED PRECEDING) AS so_far
      FROM s3 JOIN g ON g.doc_id = s3.doc_id AND g.pos = s3.pos),
j AS (SELECT doc_id, string_agg(sentence, '. ' ORDER BY pos) AS resumo, CAST(sum(n) AS BIGINT) AS n
      FROM h WHERE so_far <= {SUMMARY_WORDS} GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(resumo, '')) AS resumo_md5, coalesce(n, 0) AS n_palavras
FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id""")
def summarize_documents(spark, sf):
    made = summarize.summarize(_documents(spark, sf), "doc_id", "text", SUMMARY_WORDS)
    return made.select("doc_id", F.md5("resumo").alias("resumo_md5"), "n_palavras")


def _count_characters(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"caracteres": batch["text"].str.len().astype("int64")})


@query("enrich_distinct", "SELECT doc_id, CAST(length(text) AS BIGINT) AS caracteres FROM documents")
def enrich_distinct(spark, sf):
    outputs = T.StructType([T.StructField("caracteres", T.LongType())])
    return enrich.enrich_distinct(_documents(spark, sf), ["text"], _count_characters, outputs).select(
        "doc_id", "caracteres")


@query("criticality", f"""
WITH {B.classify_sql("documents", "doc_id", "text", B.CRITICALITY, "informativo", "criticidade", "c")}
SELECT doc_id, criticidade, CASE criticidade
  WHEN 'problema_critico' THEN '{lexicons.ACTION["problema_critico"]}'
  WHEN 'problema_atencao' THEN '{lexicons.ACTION["problema_atencao"]}'
  WHEN 'destaque_positivo' THEN '{lexicons.ACTION["destaque_positivo"]}'
  ELSE '{lexicons.ACTION["informativo"]}' END AS acao_sugerida FROM c""")
def criticality(spark, sf):
    return views.criticality(_documents(spark, sf), "text", B.CRITICALITY, "informativo",
                             lexicons.ACTION).drop("text")


# ---- labelled visits ----

def labelled(spark, sf, facts, *rules):
    """Facts with the chosen labels of their text, labelled once per text and stored.

    ``facts``: visits, or partial sums that keep the text's id.
    """
    labels = views.enriched_visits(_documents(spark, sf), "text", B.PRIORITY, "eletiva", B.RISK,
                                   "baixo_risco", only=rules).select("doc_id", *rules)
    return B.with_text_columns(facts, scratch.materialise(labels, "labels"))


def labelled_parts(spark, sf, rule, *keys):
    """Partial sums per text and ``keys``, then the label: a text's label is joined once for all
    visits of a key that share the text."""
    visits = B.with_doc(spark, sf, B.lines(spark, sf))
    return labelled(spark, sf, kpi.partials(visits, ["doc_id", *keys]), rule)


def with_specialty(spark, sf, parts):
    return parts.join(B.specialties(spark, sf), "id_medico")


@query("priority_distribution", f"""
WITH {B.VL}
SELECT prioridade, count(*) AS total_consultas,
       count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM vl) AS percentual
FROM vl GROUP BY prioridade""")
def priority_distribution(spark, sf):
    return shares.label_shares(labelled_parts(spark, sf, "prioridade"), ["prioridade"],
                               count="total_consultas", n="n")


@query("visits_by_priority", f"""
WITH {B.VL}
SELECT especialidade, prioridade, count(*) AS total FROM vl GROUP BY ALL""")
def visits_by_priority(spark, sf):
    parts = with_specialty(spark, sf, labelled_parts(spark, sf, "prioridade", "id_medico"))
    return kpi.counts_by(parts, ["especialidade", "prioridade"], n="n")


@query("urgent_by_hospital", f"""
WITH {B.VL},
u AS (SELECT id_hospital, count(*) AS urgentes FROM vl WHERE prioridade = 'urgente'
      GROUP BY id_hospital ORDER BY urgentes DESC, id_hospital LIMIT 5)
SELECT id_hospital, urgentes, s_name AS nome_hospital FROM u JOIN supplier ON s_suppkey = id_hospital""")
def urgent_by_hospital(spark, sf):
    return kpi.urgent_hospitals(labelled_parts(spark, sf, "prioridade", "id_hospital"), B.hospitals(spark, sf))


RISK_LEVEL_SQL = "CASE risco WHEN 'baixo_risco' THEN 0 WHEN 'medio_risco' THEN 1 ELSE 2 END"


@query("risk_by_specialty", f"""
WITH {B.VL}
SELECT especialidade, count(*) AS total_consultas,
       count(CASE WHEN risco = 'alto_risco' THEN 1 END) AS alto_risco,
       CAST(count(CASE WHEN risco = 'alto_risco' THEN 1 END) AS DOUBLE) / count(*) * 100.0
         AS percentual_alto,
       avg({RISK_LEVEL_SQL}) AS risco_medio
FROM vl GROUP BY especialidade""")
def risk_by_specialty(spark, sf):
    return kpi.risk_by_specialty(with_specialty(spark, sf, labelled_parts(spark, sf, "risco", "id_medico")))


@query("top_risk_hospitals", f"""
WITH {B.VL},
m AS (SELECT id_hospital, avg({RISK_LEVEL_SQL}) AS risco_medio, count(*) AS total_consultas
      FROM vl GROUP BY id_hospital ORDER BY risco_medio DESC, id_hospital LIMIT 3)
SELECT id_hospital, risco_medio, total_consultas, s_name AS nome_hospital
FROM m JOIN supplier ON s_suppkey = id_hospital""")
def top_risk_hospitals(spark, sf):
    return kpi.riskiest_hospitals(labelled_parts(spark, sf, "risco", "id_hospital"), B.hospitals(spark, sf))


@query("wait_by_priority", f"""
WITH {B.VL}
SELECT prioridade, count(*) AS total_consultas, avg(tempo_espera_minutos) AS tempo_espera_medio
FROM vl WHERE prioridade IN ('urgente', 'eletiva') GROUP BY prioridade""")
def wait_by_priority(spark, sf):
    return kpi.wait_by_priority(labelled_parts(spark, sf, "prioridade"))


@query("risk_profile", f"""
WITH {B.VL}, {B.P}
SELECT id_consulta, id_hospital, id_medico, especialidade, risco, nome_paciente, convenio,
       2024 - year(data_nascimento) AS idade
FROM vl JOIN p ON p.id_paciente = vl.id_paciente""")
def risk_profile(spark, sf):
    as_of = F.lit(B.AS_OF).cast("date")
    visits = B.with_doc(spark, sf, B.visits(spark, sf))
    profile = views.risk_profile(labelled(spark, sf, visits, "risco"), B.patients(spark, sf), as_of)
    return profile.select("id_consulta", "id_hospital", "id_medico", "especialidade", "risco",
                          "nome_paciente", "convenio", F.col("idade").cast("long").alias("idade"))


@query("rated_visits", f"""
WITH {B.V}, {B.RS},
e AS (SELECT doc_id, {_first_sql(EMAIL_SQL, "problema")} FROM documents)
SELECT v.id_consulta, id_hospital, id_medico, tempo_espera_minutos, id_avaliacao, sentimento, nota,
       problema
FROM v JOIN rs ON rs.id_consulta = v.id_consulta JOIN e ON e.doc_id = rs.doc_id""")
def rated_visits(spark, sf):
    """Visits with the sentiment of their review and one field extracted from its text."""
    texts = _documents(spark, sf).select(
        "doc_id", X.sentiment(F.col("text"), B.PRAISE, B.TOXIC).alias("sentimento"),
        X.extract_fields(F.col("text"), {"email": X.EMAIL})["email"].alias("email"))
    reviews = B.with_text_columns(B.reviews(spark, sf), texts)
    visits = B.lines(spark, sf).select(
        "id_consulta", "id_hospital", "id_medico", "tempo_espera_minutos")
    return views.rated_visits(visits, reviews, F.col("email"))
