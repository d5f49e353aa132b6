"""Every registered query against its oracle SQL, types included.

TEST_SF picks the scale of the given tables (default 0.001; the driver checks 0.01).
"""

import os

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows_as_oracle(spark, duck, name):
    difference = oracle.difference(queries()[name](spark, FOLDER), duck, oracle_sql()[name])
    assert difference is None, difference


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows_and_columns(spark):
    df = entry(spark)
    assert "total_consultas" in df.columns
    assert df.count() > 0


def test_landing_profile_counts_every_row(spark):
    df = queries()["landing_profile"](spark, FOLDER)
    total = df.selectExpr("sum(n_rows)", "min(file_size)").first()
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert total[0] == lines
    assert total[1] > 0


@pytest.mark.parametrize("name", ["kpi_epidemiology", "dense_index", "weighted_assign"])
def test_same_result_twice(spark, name):
    first = sorted(map(str, queries()[name](spark, FOLDER).collect()))
    assert first == sorted(map(str, queries()[name](spark, FOLDER).collect()))
