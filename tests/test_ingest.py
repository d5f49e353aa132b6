"""Directories that grow: each file once, runs seen whole or not at all, partitions one by one."""

import os
import time

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.plans import pipelines
from wardflow.sources import files, ingest, tables
from wardflow.testbed import files as landed

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing zone"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("\n".join(["a,b", *lines]) + "\n", encoding="utf-8")
    return str(folder), str(tmp_path / "store"), put


def state(spark, root):
    good = sorted((r.a, r.b) for r in ingest.current(spark, root, SCHEMA).collect())
    bad = sorted((r[files.RAW_LINE] for r in ingest.current(spark, root, SCHEMA, "quarentena").collect()), key=str)
    return good, bad


def test_each_file_is_read_once(spark, landing):
    folder, root, put = landing
    assert state(spark, root) == ([], []) and ingest.runs(spark, root) == []
    put("one.csv", "1,x", "2,y", "z,bad")
    put("header.csv")
    open(f"{folder}/empty.csv", "w").close()
    open(f"{folder}/_marker", "w").close()
    assert ingest.land(spark, folder, root, SCHEMA, ["a"]) == 2
    assert state(spark, root) == ([(1, "x"), (2, "y")], ["z,bad"])
    assert ingest.land(spark, folder, root, SCHEMA, ["a"]) == 0
    assert len(ingest.runs(spark, root)) == 1
    counts = {os.path.basename(r.arquivo): (r.linhas, r.rejeitadas) for r in ingest.ledger(spark, root).collect()}
    assert counts == {"one.csv": (2, 1), "header.csv": (0, 0)}
    put("late.csv", "3,w", ",nobody")
    assert ingest.land(spark, folder, root, SCHEMA, ["a"]) == 1
    first, second = ingest.runs(spark, root)
    assert state(spark, root)[0] == [(1, "x"), (2, "y"), (3, "w")]
    assert [r.a for r in ingest.current(spark, root, SCHEMA, since=first).collect()] == [3]
    assert ingest.current(spark, root, SCHEMA, since=second).count() == 0


def test_a_changed_file_replaces_its_rows(spark, landing):
    folder, root, put = landing
    put("one.csv", "1,x", "2,y")
    put("two.csv", "5,v")
    ingest.land(spark, folder, root, SCHEMA)
    first = ingest.runs(spark, root)[0]
    put("one.csv", "1,x", "2,changed", "3,more")
    assert ingest.land(spark, folder, root, SCHEMA) == 1
    assert state(spark, root)[0] == [(1, "x"), (2, "changed"), (3, "more"), (5, "v")]
    assert ingest.reread(spark, root, first) and not ingest.reread(spark, root, ingest.runs(spark, root)[1])
    os.remove(f"{folder}/two.csv")
    assert ingest.land(spark, folder, root, SCHEMA) == 0 and len(state(spark, root)[0]) == 4


def test_a_run_that_breaks_off_is_never_seen(spark, landing):
    folder, root, put = landing
    put("one.csv", "1,x")
    ingest.land(spark, folder, root, SCHEMA)
    put("two.csv", "2,y")

    def fail():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        ingest.land(spark, folder, root, SCHEMA, before_publishing=fail)
    assert state(spark, root)[0] == [(1, "x")]
    assert ingest.land(spark, folder, root, SCHEMA) == 1
    assert state(spark, root)[0] == [(1, "x"), (2, "y")]


VISIT = T.StructType([T.StructField(c, T.LongType()) for c in ("id_consulta", "id_paciente")]
                     + [T.StructField("status", T.StringType())])


def put_visits(folder, name, rows):
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(rows) + "\n")


def test_visit_tables_grow_with_the_directory(spark, tmp_path, monkeypatch):
    folder, root = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    layers = tables.create_layers(spark, scratch.new_path(spark, "ingest-test"), suffix=f"t{time.time_ns()}")

    def load():
        return pipelines.land_visits(spark, str(folder), root, VISIT, layers, ["id_consulta"], header=False)

    def ids(kind=""):
        return sorted((r[0] for r in spark.table(f"{layers['silver']}.consultas{kind}").select(
            "id_consulta").collect()), key=str)

    put_visits(folder, "a.csv", ["1,7,finalizada", "2,,finalizada", "3,8,cancelada", "x,1,finalizada"])
    assert load() == 1 and load() == 0
    assert (ids(), ids("_quarentena")) == ([1], [2, 3, None])
    put_visits(folder, "b.csv", ["4,9,finalizada", "5,,finalizada"])
    # The job breaks off after it has added the rows; a run later nothing is there twice.
    with monkeypatch.context() as m:
        m.setattr(tables, "set_property", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load()
    put_visits(folder, "c.csv", ["6,9,finalizada"])
    assert load() == 1
    assert (ids(), ids("_quarentena")) == ([1, 4, 6], [2, 3, 5, None])
    put_visits(folder, "a.csv", ["1,7,cancelada", "10,7,finalizada"])
    assert load() == 1
    assert (ids(), ids("_quarentena")) == ([10, 4, 6], [1, 5])
    tables.drop_layers(spark, layers)


def test_a_run_is_landed_and_taken_without_a_sort(spark, landing):
    folder, root, put = landing
    put("one.csv", "1,x", "z,bad")
    ingest.land(spark, folder, root, SCHEMA, ["a"])
    run = ingest.runs(spark, root)[0]
    assert not [f for f in os.listdir(f"{root}/linhas/{ingest.RUN}={run}") if "=" in f]
    rows = ingest.current(spark, root, SCHEMA)
    assert {r[ingest.RUN] for r in rows.collect()} == {run}
    assert "Sort" not in plan_of(rows.sortWithinPartitions(ingest.RUN))


def test_a_field_of_a_raw_line_is_cast_once(spark, landing):
    folder, _, put = landing
    put("one.csv", "1,x", "z,bad", "3")
    rows = files.read_csv_dir(spark, folder, SCHEMA)
    assert [tuple(r) for r in rows.select("a", "b", files.RAW_LINE).orderBy(F.col("a").asc_nulls_first()).collect()] == [
        (None, "bad", "z,bad"), (1, "x", None), (3, None, "3")]
    plan = plan_of(rows.select("a", files.RAW_LINE, F.col("_metadata.file_path")))
    assert plan.count("try_cast(") == 1 and "file_modification_time" not in plan


def test_late_lines_come_into_the_same_directory_from_one_join(spark, rows, monkeypatch):
    folder, joins = "/root/testdata/sf0.001", []
    visits = landed.B.visits
    monkeypatch.setattr(landed.B, "visits", lambda *a, **k: joins.append(1) or visits(*a, **k))
    path, bring_late = landed.landed_in_turn(spark, folder, F.col("status") == "finalizada")
    text = lambda p: rows(spark.read.text(p).select("value"))
    first = text(path)
    bring_late()
    assert len(joins) == 1 and 0 < len(first) < len(text(path))
    assert text(path) == text(landed.landed_lines(spark, folder))


def test_reloading_a_partition_leaves_the_others(spark):
    layers = tables.create_layers(spark, scratch.new_path(spark, "partition-test"), suffix=f"p{time.time_ns()}")
    name = f"{layers['silver']}.meses"
    rows = spark.range(300).select("id", F.concat(F.lit("2024-0"), F.col("id") % 3 + 1).alias("mes"))
    tables.create_table(rows, name, partition_by=["mes"])

    def stored():
        return {r[0]: r[1] for r in spark.table(name).groupBy("mes").agg(
            F.sort_array(F.collect_set("_metadata.file_path"))).collect()}

    before = stored()
    tables.replace_partitions(rows.where("mes = '2024-02'").withColumn("id", -F.col("id")), name)
    after = stored()
    assert before["2024-02"] != after.pop("2024-02") and all(before[m] == f for m, f in after.items())
    assert spark.table(name).agg(F.sum("id")).first()[0] == sum(i if i % 3 != 1 else -i for i in range(300))
    tables.replace_partitions(rows.limit(0), name)
    assert spark.table(name).count() == 300
    plan = plan_of(spark.table(name).where("mes = '2024-01'"))
    assert "PartitionFilters: [isnotnull(mes" in plan and "(mes#" in plan
    # The months to read come from the other side of a join.
    wanted = spark.createDataFrame([("2024-03", 1), ("2024-01", 0)], "mes string, n int").where("n > 0")
    joined = spark.table(name).join(F.broadcast(wanted), "mes")
    assert "dynamicpruning" in plan_of(joined) and joined.count() == 100
    tables.drop_layers(spark, layers)


def test_profile_lists_files_without_rows(spark, landing):
    folder, _, put = landing
    put("one.csv", "1,x", "2,y")
    put("header.csv")
    found = files.landing_profile(spark, folder, files.read_csv_dir(spark, folder, SCHEMA)).collect()
    assert sorted((r.file_name, r.n_rows) for r in found) == [("header.csv", 0), ("one.csv", 2)]
    assert all(r.file_size > 0 for r in found)
