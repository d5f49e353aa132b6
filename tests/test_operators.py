import random

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions import columns as C
from wardflow.operators import index, integrity, lookup, ranges, ranking, shares
from wardflow.operators.enrich import enrich_distinct


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, unique ids, and a NULL group."""
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"g{rng.randint(0, 40)}" if i % 50 else None, i)
            for i in rng.sample(range(100000), 3000)]
    return spark.createDataFrame(data, "g string, id long").repartition(6)


def test_index_equals_row_number(skewed, rows):
    expected = skewed.withColumn(
        "idx", F.row_number().over(Window.orderBy("g", "id")).cast("long") - 1)
    assert rows(index.distributed_index(skewed, ["g", "id"])) == rows(expected)


def test_index_in_group_equals_window(skewed, rows):
    part = Window.partitionBy("g")
    expected = skewed.select("g", "id", (F.row_number().over(part.orderBy("id")).cast("long") - 1),
                             F.count("*").over(part))
    found = index.index_in_group(skewed, ["g"], ["id"]).select("g", "id", "idx", "qtd")
    assert rows(found) == rows(expected)


def test_running_sum_equals_window(skewed, rows):
    weighted = skewed.withColumn("w", F.when(F.col("id") % 7 != 0, F.col("id") % 5))
    up_to = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.coalesce("w", F.lit(0))).over(up_to)
    expected = weighted.select("g", "id", "w", total, total - F.coalesce("w", F.lit(0)))
    assert rows(index.running_sum(weighted, "w", ["id"])) == rows(expected)


def test_index_has_no_one_partition_window_over_the_data(skewed):
    for df in (index.distributed_index(skewed, ["g", "id"]),
               index.index_in_group(skewed, ["g"], ["id"])):
        windows = [line for line in plan_of(df).splitlines() if "- Window [" in line]
        # The only window runs over one row per partition.
        assert windows and all("[sum(n#" in line and "__part#" in line for line in windows)


def test_index_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, w int")
    assert index.distributed_index(empty, ["id"]).collect() == []
    assert index.running_sum(empty, "w", ["id"]).collect() == []


def test_cyclic_lookup(spark, rows):
    pool = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    found = lookup.cyclic_lookup(spark.range(6), F.col("id"), 31, pool, ["name"])
    assert rows(found.select("id", "name")) == [(i, "abc"[i * 31 % 3]) for i in range(6)]
    single = lookup.cyclic_lookup(spark.range(3), F.col("id"), 31, pool.limit(1), ["name"])
    assert single.select("name").distinct().count() == 1
    none = lookup.cyclic_lookup(spark.range(3), F.col("id"), 31, pool.where("false"), ["name"])
    assert rows(none.select("id", "name")) == [(i, None) for i in range(3)]


def test_group_cyclic_lookup(spark, rows):
    pool = spark.createDataFrame([("x", "x1"), ("x", "x0"), ("y", "y0")], "g string, code string")
    data = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "z"), (5, None)], "id int, kind string")
    found = lookup.group_cyclic_lookup(data, "kind", F.col("id"), 67, pool, "g", ["code"])
    assert rows(found.select("id", "code")) == [(1, "x1"), (2, "x0"), (3, "y0"), (4, None), (5, None)]


def test_lookup_joins_on_group_and_position(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pool = spark.range(50).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("c"))
        data = spark.range(100).withColumn("kind", (F.col("id") % 3).cast("string"))
        plan = plan_of(lookup.group_cyclic_lookup(data, "kind", F.col("id"), 67, pool, "g", ["c"]))
        assert "SortMergeJoin [kind#" in plan and ", idx#" in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def random_intervals(rng, n):
    out = []
    for i in range(n):
        low = rng.randint(-5000, 5000)
        out.append((i, low, low + rng.choice([0, 1, 1, 2, 7, 8, 9, 63, 64, 65, 500, 4000])))
    return out


def test_range_join_equals_nested_loop(spark, rows):
    rng = random.Random(2)
    intervals = random_intervals(rng, 150)
    values = [rng.randint(-5200, 9200) for _ in range(400)] + [100] * 200
    points = spark.createDataFrame(list(enumerate(values)), "p int, v long")
    table = spark.createDataFrame(intervals, "i int, lo long, hi long")
    joined = ranges.range_join(points, "v", table, "lo", "hi").select("p", "i")
    expected = sorted((p, i) for p, v in enumerate(values) for i, lo, hi in intervals if lo <= v < hi)
    assert sorted(tuple(r) for r in joined.collect()) == expected
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


@pytest.mark.parametrize("kind", ["long", "int"])
def test_range_join_over_the_whole_range(spark, kind):
    low, high = (-(1 << 63), (1 << 63) - 1) if kind == "long" else (-(1 << 31), (1 << 31) - 1)
    wide = (1 << 62) + 1 if kind == "long" else 1 << 30
    intervals = [(0, -1, wide), (1, low, high), (2, -5, high), (3, low, low + 1), (4, high - 1, high), (5, -10, 3),
                 (6, 4, 4), (7, 9, 2), (8, None, 5), (9, low, 0)]
    values = [low, low + 1, -6, -1, 0, 5, wide - 1, wide, high - 1, high, None]
    points = spark.createDataFrame(list(enumerate(values)), f"p int, v {kind}")
    table = spark.createDataFrame(intervals, f"i int, lo {kind}, hi {kind}")
    found = ranges.range_join(points, "v", table, "lo", "hi").select("p", "i").collect()
    assert sorted(tuple(r) for r in found) == sorted(
        (p, i) for p, v in enumerate(values) for i, lo, hi in intervals
        if None not in (v, lo, hi) and lo <= v < hi)


def test_range_join_with_empty_sides(spark):
    points = spark.range(3)
    none = spark.createDataFrame([], "i int, lo long, hi long")
    assert ranges.range_join(points, "id", none, "lo", "hi").count() == 0


def test_weighted_assign(spark):
    weights = spark.createDataFrame([(1, 2), (2, 1), (3, 5)], "h int, w int")
    assigned = ranges.weighted_assign(spark.range(0, 80), F.col("id"), 3, weights, "w", ["h"])
    found = {r[0]: r[1] for r in assigned.groupBy("h").count().collect()}
    assert found == {1: 20, 2: 10, 3: 50}
    assert assigned.select("id").distinct().count() == assigned.count() == 80


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame([
        (1, 101, 1, 7, "finalizada", 19), (2, None, 1, 7, "finalizada", 20),
        (3, None, 2, 8, "cancelada", 0), (4, 101, 2, 8, "cancelada", 0),
        (5, 999999, 2, 8, "em_andamento", 31),
    ], "id_consulta int, id_paciente int, id_hospital int, id_medico int, status string, "
       "tempo_espera_minutos int")


def test_cleansing_splits_everything(visits, rows):
    kept, rejected = integrity.cleanse_visits(visits)
    assert sorted(r[0] for r in kept.collect()) == [1, 5]
    assert {r["id_consulta"]: r["motivo"] for r in rejected.collect()} == {
        2: "missing_patient", 3: "missing_patient", 4: "cancelled"}
    assert rows(kept.union(rejected.drop("motivo"))) == rows(visits)


def test_key_checks(spark, visits):
    patients = spark.createDataFrame([(101,), (102,)], "id_paciente int")
    broken = integrity.orphans(visits, "id_paciente", patients, "id_paciente")
    assert [r["id_consulta"] for r in broken.collect()] == [5]
    assert integrity.covered(visits, "id_paciente", patients, "id_paciente").count() == 2
    assert integrity.missing(visits, "id_paciente").count() == 2


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_optional_join_keeps_rows_without_key(spark, visits, rows, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        patients = spark.createDataFrame([(101, "Ana")], "id_paciente int, nome string")
        joined = integrity.left_join_optional(visits, "id_paciente", patients, "id_paciente",
                                              ["id_consulta"])
        assert rows(joined.select("id_consulta", "nome")) == [
            (1, "Ana"), (2, None), (3, None), (4, "Ana"), (5, None)]
        assert joined.columns == [*visits.columns, "nome"]
        if threshold == "-1":
            exchanges = [x for x in plan_of(joined).splitlines() if "Exchange hashpartitioning(" in x]
            assert exchanges and all("salt" in x for x in exchanges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = spark.range(8000).withColumn("k", F.when(F.col("id") % 3 == 0, F.col("id")))
        dim = spark.range(8000).select(F.col("id").alias("d"), F.lit("x").alias("v"))
        joined = integrity.left_join_optional(fact, "k", dim, "d", ["id"])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_visit_quality(spark, visits):
    found = integrity.visit_quality(visits).first()
    assert tuple(found) == (5, 2, 2, 2, 1, 14.0)
    assert tuple(integrity.visit_quality(visits.where("false")).first()) == (0, 0, 0, 0, 0, None)


def test_top_k_in_group(spark, rows):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "x", 1)],
                               "g string, c string, n int")
    best = ranking.top_k_in_group(df, 2, ["g"], [F.desc("n"), F.asc("c")])
    assert rows(best.select("g", "c", "posicao")) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 1)]
    assert "WindowGroupLimit" in plan_of(best)
    assert "TakeOrdered" in plan_of(ranking.first_n(df, 2, ["n", "c", "g"]))


def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")], "g string, l string")
    overall = shares.label_shares(df, ["l"])
    assert {r["l"]: (r["total"], r["percentual"]) for r in overall.collect()} == {
        "x": (4, 80.0), "y": (1, 20.0)}
    inside = shares.label_shares(df, ["l"], ["g"])
    assert {(r["g"], r["l"]): r["percentual"] for r in inside.collect()} == {
        ("a", "x"): 75.0, ("a", "y"): 25.0, ("b", "x"): 100.0}


def test_net_score(spark):
    df = spark.createDataFrame([("positive",)] * 3 + [("negative",)] + [("mixed",)] * 4 + [(None,)], "s string")
    assert tuple(shares.net_score(df, "s").first()) == (8, 25.0)


def test_sentiment_correlation(spark):
    from wardflow.plans.kpi import wait_sentiment_correlation

    df = spark.createDataFrame([(10, 1), (20, 0), (30, -1), (40, None), (None, 1)],
                               "tempo_espera_minutos int, nota int")
    assert wait_sentiment_correlation(df).first()[0] == pytest.approx(-1.0)
    flat = spark.createDataFrame([(10, 1), (10, 0)], "tempo_espera_minutos int, nota int")
    assert wait_sentiment_correlation(flat).first()[0] is None
    large = spark.createDataFrame([(b + i % 2, i % 2) for b in (30_000_000,) for i in range(3000)],
                                  "tempo_espera_minutos long, nota int")
    assert wait_sentiment_correlation(large).first()[0] == pytest.approx(1.0, abs=1e-6)


def test_enrichment_calls_once_per_distinct_input(spark, rows):
    calls = spark.sparkContext.accumulator(0)

    def length(batch):
        calls.add(len(batch))
        return batch[["t"]].assign(n=batch["t"].str.len().fillna(-1).astype("int64"))[["n"]]

    # One input fills most of the table and becomes a hot key.
    data = [(i, "igual" if i % 3 else f"texto {i}") for i in range(600)] + [(1000, None), (1001, None)]
    df = spark.createDataFrame(data, "id int, t string").repartition(5)
    outputs = T.StructType([T.StructField("n", T.LongType())])
    enriched = enrich_distinct(df, ["t"], length, outputs)
    expected = [(i, t, -1 if t is None else len(t)) for i, t in data]
    assert rows(enriched) == sorted(expected, key=lambda t: [(v is None, str(v)) for v in t])
    assert enriched.where("n > 5").count() == 200
    assert calls.value == 202


def test_enrichment_of_several_columns(spark, rows):
    data = [(1, "a", 1.5), (2, None, 1.5), (3, "a", None), (4, None, None), (5, "a", 1.5)]
    df = spark.createDataFrame(data, "id int, t string, x double")
    outputs = T.StructType([T.StructField("n", T.LongType())])
    found = enrich_distinct(df, ["t", "x"], lambda b: b.assign(n=range(len(b)))[["n"]], outputs)
    assert found.columns == ["id", "t", "x", "n"]
    assert rows(found.select("id", "t", "x")) == sorted(data, key=lambda t: [(v is None, str(v)) for v in t])


def test_phrases_against_a_large_skewed_catalogue(spark):
    from wardflow.operators.phrases import match_phrases

    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    catalogue = [(i, "common " + " ".join(rng.sample(words, 6))) for i in range(4000)]
    texts = [(i, phrase) for i, phrase in catalogue[:40]] + [(10_000 + i, "common other things") for i in range(2000)]
    found = match_phrases(spark.createDataFrame(texts, "id int, t string"), "id", "t",
                          spark.createDataFrame(catalogue, "c int, p string"), "c", "p", 0.6)
    pairs = {(r["id"], r["c"]) for r in found.collect()}
    assert {(i, i) for i in range(40)} <= pairs and not any(i >= 10_000 for i, _ in pairs)


def test_rate_counts_null_as_no(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "b boolean")
    assert df.agg(C.rate(F.col("b"))).first()[0] == 0.5


def test_phrase_matching_moves_no_candidates(spark, monkeypatch):
    """Many texts share rare words with many phrases, but hardly a pair is similar: nothing that grows
    with the pairs is stored, and several shards and blocks give the same pairs as one."""
    from wardflow import scratch
    from wardflow.operators import phrases

    rng = random.Random(9)
    texts = [(i, f"a{i % 5} b{i % 7} " + " ".join(f"t{i}x{j}" for j in range(rng.randint(0, 6)))) for i in range(400)]
    catalogue = [(i, f"a{i % 5} b{i % 7} " + " ".join(f"c{i}x{j}" for j in range(rng.randint(0, 6)))) for i in range(300)]
    rows = {}
    keep = scratch.materialise
    monkeypatch.setattr(phrases.scratch, "materialise",
                        lambda df, label: rows.setdefault(label, keep(df, label)))
    left, right = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(catalogue, "c int, p string")

    def found():
        rows.clear()
        return sorted(tuple(r) for r in phrases.match_phrases(left, "id", "t", right, "c", "p", 0.6).collect())

    one = found()
    stored = {label: df.count() for label, df in rows.items()}
    assert all(n <= max(len(texts), len(catalogue), len(one)) for n in stored.values()), stored
    for name in ("BLOCK_WORDS", "SHARD_WORDS"):
        monkeypatch.setattr(phrases, name, 200)
    assert found() == one
