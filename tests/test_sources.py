import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import schemas, scratch, session
from wardflow.sources import files, tables


def test_csv_quarantine(spark, tmp_path):
    folder = tmp_path / "avaliacoes"
    folder.mkdir()
    (folder / "part-00000.csv").write_text(
        "id_consulta,id_paciente,texto_avaliacao,data_avaliacao,canal_avaliacao,avaliacao_anonima,"
        "tempo_para_avaliar_min\n"
        '1,101,"Muito bom, rápido",2024-01-02,App,true,30\n'
        "2,,ok,2024-01-03,SMS,false,5\n"
        "x,101,ruim,2024-01-03,Site,false,7\n"
        "4,101,curto\n", encoding="utf-8")
    rows = files.read_csv_dir(spark, str(folder), schemas.REVIEWS)
    good, bad = files.split_malformed(rows, required=["id_consulta"])
    assert [tuple(r) for r in good.orderBy("id_consulta").collect()] == [
        (1, 101, "Muito bom, rápido", dt.date(2024, 1, 2), "App", True, 30),
        (2, None, "ok", dt.date(2024, 1, 3), "SMS", False, 5)]
    assert sorted(r[files.RAW_LINE] for r in bad.collect()) == ["4,101,curto", "x,101,ruim,2024-01-03,Site,false,7"]
    # The same rows whatever else is selected: nothing, one column, or all.
    assert (good.count(), bad.count()) == (2, 2)
    for name in good.columns:
        assert (good.select(name).count(), bad.select(name).count()) == (2, 2)
        assert len(good.select(name).collect()) == 2


def test_bad_values_in_columns_that_are_not_selected(spark, tmp_path):
    folder = tmp_path / "ab"
    folder.mkdir()
    (folder / "part-0.csv").write_text("a,b\n1,2\n3,x\n5,6\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    good, bad = files.split_malformed(files.read_csv_dir(spark, str(folder), schema))
    assert (good.count(), good.select("a").count(), len(good.collect()), bad.count()) == (2, 2, 2, 1)
    assert bad.first()[files.RAW_LINE] == "3,x"


def test_csv_scan_is_typed_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.range(100).select(F.col("id").cast("int").alias("a"), F.lit("finalizada").alias("status"),
                                 F.lit("x").alias("unused"))
    files.write_csv_dir(df, path, order_by=["a"])
    back = files.read_csv_text(spark, path, ["a", "status", "unused"])
    typed = back.where(F.col("status") == "finalizada").select(files.safe_cast(F.col("a"), "int").alias("a"))
    assert typed.agg(F.sum("a")).first()[0] == 4950
    plan = plan_of(typed)
    assert "EqualTo(status,finalizada)" in plan and "unused" not in plan.split("ReadSchema")[1]


def test_safe_cast(spark):
    df = spark.createDataFrame([("7",), ("",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(files.safe_cast(F.col("t"), "int")).collect()] == [7, None, None, None]


def test_free_text_survives(spark, tmp_path):
    texts = ['com "aspas", vírgula', "linha\noutra", "  pontas  ", "barra \\ \\\" fim", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    path = str(tmp_path / "t")
    files.write_csv_dir(df, path, free_text=True)
    back = files.read_csv_dir(spark, path, df.schema, free_text=True).orderBy("id").collect()
    assert [r["t"] for r in back][:4] == texts[:4]
    assert all(r[files.RAW_LINE] is None for r in back)


def test_landing_profile(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_csv_dir(spark.range(10).repartition(3), path)
    schema = T.StructType([T.StructField("id", T.LongType())])
    found = files.landing_profile(spark, path, files.read_csv_dir(spark, path, schema)).collect()
    assert sum(r["n_rows"] for r in found) == 10 and all(r["file_size"] > 0 for r in found)


@pytest.fixture
def layers(spark):
    root = scratch.new_path(spark, "test-layers")
    return tables.create_layers(spark, root, suffix=root.rsplit("-", 1)[1])


def test_table_keeps_schema_and_comments(spark, layers):
    name = f"{layers['bronze']}.hospitais"
    row = (1, "H", "Cardiologia", "C", "E", "B", "SP", "Sudeste", 10, 3, "24h", "D")
    made = tables.create_table(spark.createDataFrame([row], schemas.HOSPITALS), name, schemas.HOSPITALS)
    assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in schemas.HOSPITALS]
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert comments["id_hospital"] == "chave primaria"
    more = tables.append_rows(spark, [(2, *row[1:])], name)
    assert more.count() == 2
    assert tables.create_table(more.limit(0), f"{name}_vazia").count() == 0


def test_missing_required_value_fails_the_write(spark, layers):
    name = f"{layers['bronze']}.lexico"
    rows = "label string, term string, weight double"
    with pytest.raises(Exception, match="NULL in required column term"):
        tables.create_table(spark.createDataFrame([("a", None, 1.0)], rows), name, schemas.LEXICON)
    tables.create_table(spark.createDataFrame([("a", "b", 1.0)], rows), name, schemas.LEXICON)
    with pytest.raises(Exception, match="NULL in required column weight"):
        tables.append_query(spark.createDataFrame([("a", "c", None)], rows), name)
    with pytest.raises(Exception, match="NULL in required column term"):
        tables.append_rows(spark, [("a", None, 1.0)], name)
    assert tables.append_rows(spark, [("a", "c", 2.0)], name).count() == 2


def test_layers_are_dropped_with_their_tables(spark):
    root = scratch.new_path(spark, "test-layers")
    names = tables.create_layers(spark, root, suffix=root.rsplit("-", 1)[1])
    tables.create_table(spark.range(3), f"{names['bronze']}.t")
    tables.drop_layers(spark, names)
    assert not any(spark.catalog.databaseExists(n) for n in names.values())


def test_bucketed_table_joins_without_shuffle(spark, layers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = tables.create_table(spark.range(1000), f"{layers['silver']}.a", bucket_by=(4, ["id"]))
        right = tables.create_table(spark.range(500), f"{layers['silver']}.b", bucket_by=(4, ["id"]))
        joined = left.join(right, "id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views(spark, layers):
    tables.create_table(spark.range(3), f"{layers['bronze']}.ids")
    view = tables.create_stored_view(spark, f"{layers['silver']}.v_ids", "os 'ids'",
                                     f"SELECT id + 1 AS id FROM {layers['bronze']}.ids")
    assert sorted(r[0] for r in view.collect()) == [1, 2, 3]
    tables.append_rows(spark, [(9,)], f"{layers['bronze']}.ids")
    assert spark.table(f"{layers['silver']}.v_ids").count() == 4
    assert tables.create_view(spark.range(2), "dois").count() == 2


def test_suffix_is_checked(spark):
    with pytest.raises(ValueError):
        tables.create_layers(spark, "/tmp/x", suffix="a; DROP")


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "b")], "n int, t string")
    found = {r["column_name"]: tuple(r)[1:] for r in tables.table_profile(df).collect()}
    assert found == {"n": (3, 0, 2, "1", "3"), "t": (3, 1, 2, "a", "b")}


def test_profile_of_zeros_and_instants(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (None,), (1.5,)], "x double").withColumn(
        "t", F.when(F.col("x") < 1, F.lit("2024-10-27 00:30:00").cast("timestamp")))
    found = {r["column_name"]: r for r in tables.table_profile(df).collect()}
    assert (found["x"]["n_distinct"], found["x"]["n_nulls"]) == (2, 1)
    assert (found["t"]["n_distinct"], found["t"]["n_nulls"]) == (1, 2)


def test_settings_reach_a_given_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    assert session.apply_settings(other).conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.new_path(spark, "x")
    assert path != scratch.new_path(spark, "x")
    if shared:
        assert path.startswith(shared.rstrip("/"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.root(Session())
