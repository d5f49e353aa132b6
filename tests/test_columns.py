import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import columns as C
from wardflow.functions import identifiers as ids


def counts(df, column):
    return {r[0]: r[1] for r in df.groupBy(column.alias("x")).count().collect()}


def test_bucket_shares_are_exact(spark):
    visits = spark.range(1001, 2001)
    key = F.col("id")
    status = C.assign_bucket(key, 11, 100, [(85, "finalizada"), (95, "cancelada")], "em_andamento")
    assert counts(visits, status) == {"finalizada": 850, "cancelada": 100, "em_andamento": 50}
    mode = C.assign_bucket(key, 53, 100, [(60, "presencial"), (90, "retorno")], "telemedicina")
    assert counts(visits, mode) == {"presencial": 600, "retorno": 300, "telemedicina": 100}
    assert visits.where(C.spread(key, 7, 10) == 0).count() == 100
    patients = spark.range(101, 1601)
    plan = C.assign_bucket(key, 13, 100, [(60, "a"), (75, "b"), (87, "c"), (95, "d")], "e")
    assert counts(patients, plan) == {"a": 900, "b": 225, "c": 180, "d": 120, "e": 75}
    civil = C.assign_bucket(key, 19, 100, [(35, "s"), (85, "c"), (95, "d")], "v")
    assert counts(patients, civil) == {"s": 525, "c": 750, "d": 150, "v": 75}


def test_wait_bands_at_their_edges(spark):
    df = spark.createDataFrame([(0,), (19,), (20,), (30,), (31,), (118,), (None,)], "w int")
    found = [r[0] for r in df.select(C.wait_band(F.col("w"))).collect()]
    assert found == ["<20", "<20", "20..30", "20..30", ">30", ">30", None]


def test_nested_bands(spark):
    cuts = {"<20": [(75, "a"), (85, "b")], ">30": [(15, "a"), (85, "b")]}
    df = spark.createDataFrame([(5, 74), (5, 75), (5, 85), (40, 14), (40, 15), (25, 1), (None, 1)], "w int, d int")
    label = C.nested_band(C.wait_band(F.col("w")), F.col("d"), cuts, "c")
    assert [r[0] for r in df.select(label).collect()] == ["a", "b", "c", "a", "b", None, None]


def test_mean_keeps_all_digits(spark):
    df = spark.createDataFrame([(0.001,), (0.002,), (None,)], "x double")
    assert df.agg(C.mean(F.col("x"))).first()[0] == 0.0015


def test_both_ages(spark):
    as_of = F.lit("2024-02-29").cast("date")
    births = [dt.date(2004, 2, 29), dt.date(2004, 3, 1), dt.date(2003, 12, 31), dt.date(2024, 2, 29)]
    df = spark.createDataFrame([(b,) for b in births], "b date")
    found = [tuple(r) for r in df.select(
        C.whole_years(F.col("b"), as_of), C.calendar_years(F.col("b"), as_of)).collect()]
    assert found == [(20, 20), (19, 20), (20, 21), (0, 0)]


def test_age_and_delay_bands(spark):
    df = spark.createDataFrame([(0,), (17,), (18,), (34,), (35,), (64,), (65,), (None,)], "a int")
    assert [r[0] for r in df.select(C.age_band(F.col("a"))).collect()] == [
        "0-17", "0-17", "18-34", "18-34", "35-49", "50-64", "65+", None]
    delays = spark.createDataFrame([(119,), (120,), (1440,), (7200,)], "m int")
    assert [r[0] for r in delays.select(C.delay_band(F.col("m"))).collect()] == [
        "ate 2h", "2h a 24h", "1 a 5 dias", "mais de 5 dias"]


def test_spread_is_never_negative(spark):
    df = spark.createDataFrame([(-3,), (7,)], "k long")
    assert [r[0] for r in df.select(C.spread(F.col("k"), 1, 5)).collect()] == [2, 2]
    large = spark.createDataFrame([(2 ** 62 + 5,)], "k long")
    assert large.select(C.spread(F.col("k"), 379, 1000)).first()[0] == (2 ** 62 + 5) * 379 % 1000


def test_numbers_in_templates(spark):
    rows = [(0,), (12345678901,), (7,), (-1,), (123456789012,), (None,)]
    df = spark.createDataFrame(rows, "n long").select(ids.laid_out(F.col("n"), "###.###.###-##").alias("v"))
    assert [r[0] for r in df.collect()] == [
        "000.000.000-00", "123.456.789-01", "000.000.000-07", None, None, None]
    assert df.where("v IS NOT NULL").where(~ids.matches(F.col("v"), "cpf")).count() == 0
    both = spark.range(1).select(ids.laid_out(F.lit(42), "<##>"), ids.laid_out(F.lit(4), "#"))
    assert tuple(both.first()) == ("<42>", "4")


def test_ascii_key(spark):
    df = spark.createDataFrame([("João", "Conceição", 7), (None, "Lima", 8)], "a string, b string, k int")
    found = [r[0] for r in df.select(ids.email(F.col("a"), F.col("b"), F.col("k"), "x.br")).collect()]
    assert found == ["joao.conceicao7@x.br", None]
