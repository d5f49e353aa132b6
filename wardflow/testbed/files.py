"""Raw directories, tables and views over the bound frames."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.operators import integrity, label_store, sketches
from wardflow.operators.integrity import split_rows
from wardflow.functions import text as X
from wardflow.plans import pipelines
from wardflow.sources import files, tables
from wardflow.testbed import binding as B
from wardflow.testbed.registry import query

RAW_VISITS = T.StructType([
    T.StructField("id_consulta", T.LongType()),
    T.StructField("id_paciente", T.LongType()),
    T.StructField("id_hospital", T.LongType()),
    T.StructField("id_medico", T.LongType()),
    T.StructField("modalidade", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tempo_espera_minutos", T.IntegerType()),
    T.StructField("cid_10", T.StringType()),
    T.StructField("diagnostico_descricao", T.StringType()),
])


def landed_visits(spark, sf):
    """The visits written as a raw directory, and its path."""
    path = scratch.new_path(spark, "landing-consultas")
    rows = B.visits(spark, sf).select(*RAW_VISITS.names)
    files.write_csv_dir(rows, path, order_by=["id_consulta", "id_medico", "id_hospital"])
    return path


@query("csv_roundtrip", f"""
WITH {B.V}
SELECT id_consulta, id_paciente, id_hospital, id_medico, modalidade, status, tempo_espera_minutos,
       cid_10, diagnostico_descricao FROM v""")
def csv_roundtrip(spark, sf):
    rows = files.read_csv_dir(spark, landed_visits(spark, sf), RAW_VISITS)
    good, _ = files.split_malformed(rows, required=["id_consulta", "id_hospital"])
    return good


@query("landing_profile")
def landing_profile(spark, sf):
    path = landed_visits(spark, sf)
    return files.landing_profile(spark, path, files.read_csv_dir(spark, path, RAW_VISITS))


@query("landing_totals", f"""
WITH {B.V}
SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS has_files, true AS has_bytes FROM v""")
def landing_totals(spark, sf):
    """What the profile of the files adds up to."""
    return landing_profile(spark, sf).agg(
        F.sum("n_rows").alias("n_rows"), (F.count("*") > 0).alias("has_files"),
        (F.min("file_size") > 0).alias("has_bytes"))


# Lines of a raw directory: most are whole, some have text for a number, some too few fields.
LINE_SQL = """
line AS (SELECT *, CASE id_consulta % 50
    WHEN 8 THEN concat_ws(',', id_consulta, coalesce(CAST(id_paciente AS VARCHAR), ''), id_hospital)
    ELSE concat_ws(',', id_consulta, coalesce(CAST(id_paciente AS VARCHAR), ''), id_hospital, id_medico,
                   modalidade, status, CASE id_consulta % 50 WHEN 7 THEN 'x' ELSE '' END || tempo_espera_minutos,
                   coalesce(cid_10, ''), coalesce(diagnostico_descricao, '')) END AS linha FROM v)"""


def _raw_line():
    """A visit as a raw line; some have text for a number, some too few fields."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    kind = F.pmod(F.col("id_consulta"), F.lit(50).cast("long"))
    wait = F.concat(F.when(kind == 7, "x").otherwise(""), text("tempo_espera_minutos"))
    fields = [wait if c == "tempo_espera_minutos" else text(c) for c in RAW_VISITS.names]
    return F.when(kind == 8, F.concat_ws(",", *fields[:3])).otherwise(F.concat_ws(",", *fields))


def landed_lines(spark, sf):
    """The visits as raw lines without a header, bad ones among them; the path."""
    path = scratch.new_path(spark, "landing-linhas")
    B.visits(spark, sf).select(_raw_line().alias("value")).write.text(path)
    return path


def landed_in_turn(spark, sf, early):
    """The same lines, those of a condition first: the path of a directory that has these, and a call
    that brings the others. The visits are joined once; the later files lie aside until they come."""
    path, aside = (scratch.new_path(spark, label) for label in ("landing-linhas", "a-caminho"))
    B.visits(spark, sf).select(
        _raw_line().alias("value"), F.when(early, "cedo").otherwise("tarde").alias("entrega"),
    ).write.partitionBy("entrega").text(aside)

    def arrive(delivery):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        landing, source = hadoop.Path(path), hadoop.Path(f"{aside}/entrega={delivery}")
        system = landing.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(landing)
        # No visit may be late, or none early.
        if system.exists(source) and not system.rename(source, hadoop.Path(f"{path}/entrega={delivery}")):
            raise OSError(f"{source} could not be moved to {path}")

    arrive("cedo")
    return path, lambda: arrive("tarde")


@query("malformed_rows", f"""
WITH {B.V}, {LINE_SQL}
SELECT CASE WHEN id_consulta % 50 IN (7, 8) THEN 'ruim' ELSE 'boa' END AS destino, linha FROM line""")
def malformed_rows(spark, sf):
    """Good rows as lines again, and the text of the bad ones."""
    rows = files.read_csv_dir(spark, landed_lines(spark, sf), RAW_VISITS, header=False)
    good, bad = files.split_malformed(rows, required=["id_consulta", "id_hospital"])
    again = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_VISITS.names])
    return good.select(F.lit("boa").alias("destino"), again.alias("linha")).unionByName(
        bad.select(F.lit("ruim").alias("destino"), F.col(files.RAW_LINE).alias("linha")))


@query("text_csv_roundtrip", """
SELECT doc_id, md5(text) AS texto_md5, lang, source FROM documents""")
def text_csv_roundtrip(spark, sf):
    """Free text with commas, quotes and line breaks through a raw directory."""
    rows = B.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    path = scratch.new_path(spark, "landing-textos")
    files.write_csv_dir(rows, path, free_text=True)
    good, _ = files.split_malformed(
        files.read_csv_dir(spark, path, rows.schema, free_text=True), required=["doc_id"])
    return good.select("doc_id", F.md5("text").alias("texto_md5"), "lang", "source")


def _layers(spark, label):
    """Fresh databases for one run, so that two runs never share a table."""
    root = scratch.new_path(spark, label)
    return tables.create_layers(spark, root, suffix=root.rsplit("-", 1)[1])


HOSPITALS = T.StructType([
    T.StructField("id_hospital", T.LongType(), False, {"comment": "chave primaria"}),
    T.StructField("nome_hospital", T.StringType(), False),
    T.StructField("cidade", T.StringType(), False),
    T.StructField("regiao", T.StringType(), False),
    T.StructField("qtd_leitos", T.LongType(), False),
])


@query("table_roundtrip", f"""
WITH {B.H} SELECT id_hospital, nome_hospital, cidade, regiao, qtd_leitos FROM h""")
def table_roundtrip(spark, sf):
    bronze = _layers(spark, "tables")["bronze"]
    return tables.create_table(B.hospitals(spark, sf), f"{bronze}.hospitais", HOSPITALS)


@query("append_rows", f"""
WITH {B.H}
SELECT id_hospital, nome_hospital, cidade, regiao, qtd_leitos FROM h
UNION ALL SELECT id_hospital + 1000000, nome_hospital, cidade, regiao, qtd_leitos + 1 FROM h
UNION ALL SELECT -1, 'Hospital Modelo', 'Campinas', 'Sudeste', 10""")
def append_rows(spark, sf):
    name = f"{_layers(spark, 'tables')['bronze']}.hospitais"
    hospitals = B.hospitals(spark, sf)
    tables.create_table(hospitals, name, HOSPITALS)
    tables.append_rows(spark, [(-1, "Hospital Modelo", "Campinas", "Sudeste", 10)], name)
    second = hospitals.withColumns({"id_hospital": F.col("id_hospital") + 1000000,
                                    "qtd_leitos": F.col("qtd_leitos") + 1})
    return tables.append_query(second, name)


@query("table_profile", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
    f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")))
def table_profile(spark, sf):
    return tables.table_profile(B.table(spark, sf, "orders"))


@query("enriched_view", f"""
WITH {B.VL}
SELECT id_consulta, id_paciente, id_hospital, id_medico, especialidade, tempo_espera_minutos, status,
       prioridade, risco FROM vl""")
def enriched_view(spark, sf):
    """Labels come from the store of labels, which labels new texts only; the view joins them to the
    fact where it lies."""
    silver = _layers(spark, "views")["silver"]
    texts = label_store.labelled_by_rules(
        B.documents(spark, sf), "text", scratch.new_path(spark, "rotulos"),
        {"prioridade": (B.PRIORITY, "eletiva"), "risco": (B.RISK, "baixo_risco")})
    tables.create_table(texts.where("text IS NOT NULL").drop("text"), f"{silver}.textos_rotulados")
    stored = lambda name: f"parquet.`{sf}/{name}.parquet`"
    return tables.create_stored_view(
        spark, f"{silver}.v_consultas_enriquecidas",
        "Consultas com prioridade e risco", f"""
        SELECT l_orderkey AS id_consulta,
               CASE WHEN pmod(o_orderkey, 13) <> 5 THEN o_custkey END AS id_paciente,
               l_suppkey AS id_hospital, l_partkey AS id_medico, p_type AS especialidade,
               CAST(l_quantity AS INT) AS tempo_espera_minutos,
               CASE o_orderstatus WHEN 'F' THEN 'finalizada' WHEN 'P' THEN 'cancelada'
                    ELSE 'em_andamento' END AS status, prioridade, risco
        FROM {stored("lineitem")} JOIN {stored("orders")} ON o_orderkey = l_orderkey
        JOIN {stored("part")} ON p_partkey = l_partkey
        JOIN {silver}.textos_rotulados
          ON doc_id = pmod(l_orderkey, (SELECT count(*) FROM {stored("documents")}))""")


@query("rejected_rows", f"""
WITH {B.V}
SELECT CASE WHEN id_paciente IS NULL THEN 'missing_patient'
            WHEN tempo_espera_minutos > 30 THEN 'long_wait' END AS motivo, count(*) AS total
FROM v WHERE id_paciente IS NULL OR tempo_espera_minutos > 30 GROUP BY 1""")
def rejected_rows(spark, sf):
    """The general split by reasons, counted per reason."""
    _, rejected = split_rows(B.visits(spark, sf, codes=False), [
        ("missing_patient", F.col("id_paciente").isNull()),
        ("long_wait", F.col("tempo_espera_minutos") > 30)])
    return rejected.groupBy("motivo").agg(F.count("*").alias("total"))


# ---- the jobs end to end ----

REVIEWS = T.StructType([
    T.StructField("id_consulta", T.LongType(), False), T.StructField("turno", T.LongType(), False),
    T.StructField("texto_avaliacao", T.StringType()), T.StructField("data_avaliacao", T.DateType()),
    T.StructField("canal_avaliacao", T.StringType(), False), T.StructField("avaliacao_anonima", T.BooleanType()),
    T.StructField("tempo_para_avaliar_min", T.IntegerType()),
])
C_SQL = """
c AS (SELECT conv_id AS id_consulta, turn AS turno, nullif(text, '') AS texto_avaliacao,
             DATE '2024-01-01' + CAST(turn AS INTEGER) AS data_avaliacao, role AS canal_avaliacao,
             turn % 2 = 0 AS avaliacao_anonima, CAST(turn * 45 AS INTEGER) AS tempo_para_avaliar_min
      FROM conversations)"""
SILVER_SQL = f"""{LINE_SQL}, {C_SQL},
good AS (SELECT * FROM line WHERE id_consulta % 50 NOT IN (7, 8)),
silver AS (SELECT * FROM good WHERE id_paciente IS NOT NULL AND status <> 'cancelada')"""


def landed_reviews(spark, sf):
    """Turns of conversations as reviews of the visit with the conversation's id; the path."""
    turn = F.col("turn").cast("int")
    rows = B.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id_consulta"), F.col("turn").alias("turno"), F.col("text").alias("texto_avaliacao"),
        F.date_add(F.lit("2024-01-01").cast("date"), turn).alias("data_avaliacao"),
        F.col("role").alias("canal_avaliacao"), (turn % 2 == 0).alias("avaliacao_anonima"),
        (turn * 45).alias("tempo_para_avaliar_min"))
    path = scratch.new_path(spark, "landing-avaliacoes")
    files.write_csv_dir(rows, path, free_text=True)
    return path


def _stored_visits(spark, sf, layers):
    return pipelines.store_visits(spark, landed_lines(spark, sf), RAW_VISITS, layers,
                                  ["id_consulta", "id_hospital"], header=False)


@query("pipeline_silver", f"""
WITH {B.V}, {SILVER_SQL}
SELECT CASE WHEN id_consulta % 50 IN (7, 8) THEN 'malformed' WHEN id_paciente IS NULL THEN 'missing_patient'
            WHEN status = 'cancelada' THEN 'cancelled' ELSE 'silver' END AS destino,
       linha FROM line""")
def pipeline_silver(spark, sf):
    """Silver visits and their quarantine as stored, each row as its line."""
    return _as_lines(*_stored_visits(spark, sf, _layers(spark, "pipeline")))


def _as_lines(kept, rejected):
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_VISITS.names])
    return kept.select(F.lit("silver").alias("destino"), line.alias("linha")).unionByName(
        rejected.select(F.col("motivo").alias("destino"), F.coalesce(files.RAW_LINE, line).alias("linha")))


@query("pipeline_reviews", f"""
WITH {C_SQL}
SELECT id_consulta, turno, md5(texto_avaliacao) AS texto_md5, CAST(data_avaliacao AS VARCHAR) AS data_avaliacao,
       canal_avaliacao, avaliacao_anonima, tempo_para_avaliar_min FROM c""")
def pipeline_reviews(spark, sf):
    """Reviews with dates and flags, through a raw directory into bronze."""
    stored, _ = pipelines.store_reviews(spark, landed_reviews(spark, sf), REVIEWS, _layers(spark, "pipeline"),
                                        ["id_consulta"])
    return stored.select("id_consulta", "turno", F.md5("texto_avaliacao").alias("texto_md5"),
                         F.col("data_avaliacao").cast("string").alias("data_avaliacao"), "canal_avaliacao",
                         "avaliacao_anonima", "tempo_para_avaliar_min")


@query("pipeline_360", f"""
WITH {B.V}, {SILVER_SQL}, {B.H}, {B.P}
SELECT id_consulta, s.id_hospital, id_medico, cidade, regiao, nome_paciente, idade, convenio
FROM silver s JOIN h ON h.id_hospital = s.id_hospital LEFT JOIN p ON p.id_paciente = s.id_paciente""")
def pipeline_360(spark, sf):
    layers = _layers(spark, "pipeline")
    _stored_visits(spark, sf, layers)
    made = pipelines.store_360(spark, B.hospitals(spark, sf), B.patients(spark, sf), layers)
    return made.select("id_consulta", "id_hospital", "id_medico", "cidade", "regiao", "nome_paciente", "idade",
                       "convenio")


@query("pipeline_gold", f"""
WITH {B.V}, {SILVER_SQL}, {B.H},
l AS (SELECT id_consulta, {B.sentiment_case_sql("f", B.PRAISE, B.TOXIC)} AS sentimento
      FROM (SELECT id_consulta, {B.fold_sql("texto_avaliacao")} AS f FROM c WHERE texto_avaliacao IS NOT NULL)),
n AS (SELECT id_hospital, sum(CASE sentimento WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END) AS s,
             count(*) AS k FROM silver JOIN l ON l.id_consulta = silver.id_consulta GROUP BY id_hospital),
g AS (SELECT id_hospital, count(*) AS volume, avg(tempo_espera_minutos) AS tempo_espera_medio
      FROM silver GROUP BY id_hospital)
SELECT g.id_hospital, nome_hospital, volume, tempo_espera_medio,
       CAST(s AS DOUBLE) / CAST(k AS DOUBLE) AS sentimento_medio,
       (SELECT count(*) FROM c) AS avaliacoes_recebidas
FROM g JOIN h ON h.id_hospital = g.id_hospital LEFT JOIN n ON n.id_hospital = g.id_hospital""")
def pipeline_gold(spark, sf):
    """All five jobs, one after the other; the gold table as stored."""
    layers, hospitals = _layers(spark, "pipeline"), B.hospitals(spark, sf)
    _stored_visits(spark, sf, layers)
    pipelines.store_reviews(spark, landed_reviews(spark, sf), REVIEWS, layers, ["id_consulta"])
    pipelines.store_360(spark, hospitals, B.patients(spark, sf), layers)
    pipelines.store_rated(spark, B.PRAISE, B.TOXIC, X.EMAIL, layers)
    return pipelines.store_gold(spark, hospitals, layers)


@query("pipeline_incremental", f"""
WITH {B.V}, {SILVER_SQL}
SELECT CASE WHEN id_consulta % 50 IN (7, 8) THEN 'malformed' WHEN id_paciente IS NULL THEN 'missing_patient'
            WHEN status = 'cancelada' THEN 'cancelled' ELSE 'silver' END AS destino,
       linha FROM line""")
def pipeline_incremental(spark, sf):
    """The same tables as ``pipeline_silver`` from a directory that grows: a first load, one that brings
    nothing, and one of files that came late."""
    layers, root = _layers(spark, "incremental"), scratch.new_path(spark, "ingest")
    early = F.col("status") == "finalizada"
    path, bring_late = landed_in_turn(spark, sf, early)
    required = ["id_consulta", "id_hospital"]
    for files_come in (None, None, bring_late):
        if files_come:
            files_come()
        pipelines.land_visits(spark, path, root, RAW_VISITS, layers, required, header=False)
    kept, rejected = (spark.table(f"{layers['silver']}.consultas{x}") for x in ("", "_quarentena"))
    return _as_lines(kept, rejected)


@query("partition_reload", f"""
WITH {B.V}
SELECT modalidade, id_hospital, count(*) AS total, CAST(sum(CASE WHEN modalidade = 'retorno'
       THEN tempo_espera_minutos + 1 ELSE tempo_espera_minutos END) AS BIGINT) AS espera FROM v GROUP BY ALL""")
def partition_reload(spark, sf):
    """Visits stored by modality; one modality is loaded anew, the others keep their files."""
    name = f"{_layers(spark, 'partitions')['silver']}.consultas"
    visits = B.lines(spark, sf)
    tables.create_table(visits, name, partition_by=["modalidade"])
    again = visits.where("modalidade = 'retorno'").withColumn(
        "tempo_espera_minutos", F.col("tempo_espera_minutos") + 1)
    stored = tables.replace_partitions(again, name)
    return stored.groupBy("modalidade", "id_hospital").agg(
        F.count("*").alias("total"), F.sum("tempo_espera_minutos").alias("espera"))


@query("bucketed_join", f"""
WITH {B.V}, {B.R}
SELECT v.id_consulta, count(*) AS linhas, CAST(sum(tempo_espera_minutos) AS BIGINT) AS espera,
       max(tempo_para_avaliar_min) AS resposta
FROM v JOIN r ON r.id_consulta = v.id_consulta GROUP BY v.id_consulta""")
def bucketed_join(spark, sf):
    """Visits and reviews stored by the visit's bucket: joined and summed up where they lie."""
    silver = _layers(spark, "buckets")["silver"]
    by_visit = (16, ["id_consulta"])
    visits = tables.create_table(B.lines(spark, sf), f"{silver}.consultas", bucket_by=by_visit)
    reviews = tables.create_table(
        B.reviews(spark, sf).select("id_consulta", "tempo_para_avaliar_min"), f"{silver}.avaliacoes", bucket_by=by_visit)
    return visits.hint("merge").join(reviews, "id_consulta").groupBy("id_consulta").agg(
        F.count("*").alias("linhas"), F.sum("tempo_espera_minutos").alias("espera"),
        F.max("tempo_para_avaliar_min").alias("resposta"))


@query("quality_store", f"""
WITH {B.V},
k AS (SELECT id_consulta, id_medico, id_hospital FROM v GROUP BY ALL HAVING count(*) > 1),
m AS (SELECT v.*, concat_ws('+', CASE WHEN id_paciente IS NULL THEN 'missing_patient' END,
             CASE WHEN status = 'cancelada' THEN 'cancelled' END, CASE WHEN tempo_espera_minutos > 30 THEN 'long_wait' END,
             CASE WHEN k.id_consulta IS NOT NULL THEN 'duplicate_key' END) AS motivos
      FROM v LEFT JOIN k ON k.id_consulta = v.id_consulta AND k.id_medico = v.id_medico AND k.id_hospital = v.id_hospital)
SELECT 'guardado' AS medida, motivos AS nome, count(*) AS total FROM m GROUP BY motivos
UNION ALL SELECT 'observado', 'total', count(*) FROM m
UNION ALL SELECT 'observado', n, count(*) FILTER (list_contains(string_split(motivos, '+'), n))
FROM m, unnest(['missing_patient', 'cancelled', 'long_wait', 'duplicate_key']) u(n) GROUP BY n""")
def quality_store(spark, sf):
    """Visits stored with every reason against them; the counts were observed during the write."""
    rules = [("missing_patient", F.col("id_paciente").isNull()), ("cancelled", F.col("status") == "cancelada"),
             ("long_wait", F.col("tempo_espera_minutos") > 30)]
    kept, rejected, counts = integrity.store_checked(
        B.visits(spark, sf, codes=False), scratch.new_path(spark, "checked"), rules,
        unique=["id_consulta", "id_medico", "id_hospital"])
    named = kept.select(F.lit("").alias("nome")).unionByName(
        rejected.select(F.array_join("motivos", "+").alias("nome")))
    stored = named.groupBy("nome").agg(F.count("*").alias("total")).select(
        F.lit("guardado").alias("medida"), "nome", "total")
    seen = spark.createDataFrame([("observado", k, v) for k, v in counts.items()], stored.schema)
    return stored.unionByName(seen)


@query("sketch_profile")
def sketch_profile(spark, sf):
    """Profiles of the order lines per return flag, merged into that of the table."""
    parts = scratch.materialise(
        sketches.sketch_profile(B.table(spark, sf, "lineitem"), ["l_returnflag"]), "profiles")
    return sketches.read_profile(sketches.merge_profiles(parts), [0.25, 0.5, 0.75])
