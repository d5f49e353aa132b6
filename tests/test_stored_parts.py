"""Reasons and counts from one write, moments and sketches that merge, joins of buckets."""

import math
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.operators import integrity, moments, sketches
from wardflow.sources import tables

def rules():
    return [("no_a", F.col("a").isNull()), ("large", F.col("b") > 5)]


def test_every_reason_and_observed_counts(spark, tmp_path):
    rows = [(1, 2, "x"), (None, 9, "y"), (1, 7, "z"), (3, None, "w"), (None, None, "x"), (4, 4, "u")]
    df = spark.createDataFrame(rows, "a int, b int, k string").repartition(3)
    kept, rejected, counts = integrity.store_checked(df, str(tmp_path / "t"), rules(), unique=["k"])
    assert kept.columns == df.columns
    assert sorted(r.k for r in kept.collect()) == ["u", "w"]
    assert sorted((r.k, r.b is None, r.motivos) for r in rejected.collect()) == [
        ("x", False, ["duplicate_key"]), ("x", True, ["no_a", "duplicate_key"]), ("y", False, ["no_a", "large"]),
        ("z", False, ["large"])]
    assert counts == {"total": 6, "no_a": 2, "large": 2, "duplicate_key": 2}


def test_null_keys_empty_tables_and_too_many_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, None), (3, "q")], "a int, k string").withColumn("b", F.lit(0))
    _, rejected, counts = integrity.store_checked(df, str(tmp_path / "a"), rules(), unique=["k"])
    assert counts["duplicate_key"] == 2 and rejected.count() == 2
    kept, rejected, counts = integrity.store_checked(df.limit(0), str(tmp_path / "b"), rules(), unique=["k"])
    assert kept.count() == rejected.count() == 0 and set(counts.values()) == {0}
    with pytest.raises(ValueError, match="62"):
        integrity.mark_rows(df, rules() * 32)


def test_counts_need_no_second_scan(spark, tmp_path):
    passes = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(a):
        passes.add(1)
        return a

    df = spark.range(50).select(seen(F.col("id").cast("int")).alias("a"), F.lit(1).alias("b"))
    _, _, counts = integrity.store_checked(df, str(tmp_path / "t"), rules())
    assert counts == {"total": 50, "no_a": 0, "large": 0} and passes.value == 50


def close(a, b, rel=1e-9):
    return (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=rel, abs_tol=1e-12))


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_moments_equal_direct_ones(spark, offset):
    # A mean of 1e9 has seven digits behind the point, in either form; sums of squares would have none.
    rel = 1e-5 if offset else 1e-9
    rng = random.Random(1)
    rows = [(i % 4 if i % 7 else None, i % 11, offset + rng.random(), offset - rng.random()) for i in range(900)]
    rows += [(9, i, offset + i, offset + 2 * i) for i in range(5)]      # groups of one row
    rows += [(8, 1, 5.0, float(i)) for i in range(4)] + [(7, 1, None, 1.0)]  # constant; nothing to count
    df = spark.createDataFrame(rows, "g int, f int, x double, y double")
    parts = moments.partial_moments(df, ["g", "f"], "x", "y")
    found = {r.g: r for r in moments.merged(parts, ["g"]).select(
        "g", "n", moments.correlation().alias("r"), moments.deviation("m2_x").alias("d")).collect()}
    direct = df.where("x IS NOT NULL AND NOT g <=> 8").groupBy("g").agg(
        F.count("*").alias("n"), F.corr("x", "y").alias("r"), F.stddev_pop("x").alias("d")).collect()
    assert set(found) == {r.g for r in direct} | {8}
    for r in direct:
        assert found[r.g].n == r.n and close(found[r.g].r, r.r, rel) and close(found[r.g].d, r.d, rel)
    # A constant column has no correlation: NULL here, an error in the built-in form.
    assert (found[8].n, found[8].r, found[8].d) == (4, None, 0.0)
    whole = moments.merged(parts, []).select(moments.correlation().alias("r"), "n").first()
    both = df.where("x IS NOT NULL")
    assert whole.n == both.count() and close(whole.r, both.select(F.corr("x", "y")).first()[0], rel)
    twice = moments.merged(moments.merged(parts, ["g"]), []).select(moments.correlation()).first()[0]
    assert close(twice, whole.r, rel)
    assert moments.merged(parts.limit(0), ["g"]).count() == 0


def test_sketches_of_parts_stay_within_their_error(spark):
    n = 40_000
    df = spark.range(n).select(
        (F.col("id") % 7).alias("parte"), (F.col("id") * 7 % n).cast("double").alias("valor"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 5000)).alias("texto"),
        F.lit(None).cast("int").alias("nada"), F.when(F.col("id") == 5, float("nan")).otherwise(9.0).alias("nan"))
    parts = scratch.materialise(sketches.sketch_profile(df, ["parte"]), "profile")
    whole = sketches.read_profile(sketches.merge_profiles(parts), [0.1, 0.5, 0.9])
    direct = sketches.read_profile(sketches.sketch_profile(df.drop("parte")), [0.1, 0.5, 0.9])
    for profile in (whole, direct):
        found = {r.column_name: r for r in profile.collect()}
        assert set(found) == {"valor", "texto", "nada", "nan"} and all(r.n_rows == n for r in found.values())
        assert abs(found["valor"].n_distinct - n) < sketches.HLL_ERROR * n
        assert abs(found["texto"].n_distinct - 5000) < sketches.HLL_ERROR * 5000
        assert (found["nada"].n_distinct, found["nada"].n_nulls, found["nada"].quantiles) == (0, n, None)
        assert found["texto"].n_nulls == math.ceil(n / 3)
        assert (found["valor"].min_value, float(found["valor"].max_value)) == ("0.0", n - 1)
        for q, value in zip([0.1, 0.5, 0.9], found["valor"].quantiles, strict=True):
            assert abs(value - q * n) < sketches.KLL_ERROR * n
    assert parts.count() == 7 * 4
    empty = sketches.read_profile(sketches.sketch_profile(df.limit(0).drop("parte"))).collect()
    assert len(empty) == 4 and all(r.n_rows == 0 and r.min_value is None and r.n_distinct == 0 for r in empty)


def test_buckets_are_joined_and_grouped_without_an_exchange(spark):
    from __spark_entry__ import queries
    plan = plan_of(queries()["bucketed_join"](spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan


def test_bucketed_tables_hold_the_rows(spark):
    layers = tables.create_layers(spark, scratch.new_path(spark, "bucket-test"), suffix="buckettest")
    df = spark.range(1000).withColumn("v", F.col("id") % 9)
    stored = tables.create_table(df, f"{layers['silver']}.b", bucket_by=(4, ["v"]))
    assert stored.groupBy("v").count().count() == 9 and stored.count() == 1000
    tables.drop_layers(spark, layers)


def test_a_task_of_a_shuffle_reads_little(spark):
    """48 MB of shuffled rows are several tasks, also where cores would not ask for it."""
    from wardflow.session import apply_settings

    apply_settings(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        rows = spark.range(2_000_000).select(*(F.xxhash64(F.col("id") + i).alias(f"c{i}") for i in range(3)))
        tasks = rows.repartition("c0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert tasks > 1
