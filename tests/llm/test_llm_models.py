"""Language ID by held-out accuracy, quality selection against brute force."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import langid, quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents)


def test_held_out_accuracy_and_calibration(documents, model):
    found = langid.predict(documents, model).where(langid.held_out(F.col("doc_id"))).collect()
    right = [r.lang == r.lang_pred for r in found]
    assert np.mean(right) > 0.97
    assert abs(np.mean([r.score for r in found]) - np.mean(right)) < 0.05
    assert {r.lang_pred for r in found} <= {*model.labels, "und"}


def test_held_out_rows_and_unlabelled_rows_teach_nothing(spark, documents, model):
    held = langid.held_out(F.col("doc_id"))
    changed = documents.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "text", F.when(held, F.lit("zzz")).otherwise(F.col("text"))).withColumn("source", F.lit("s"))
    extra = changed.limit(5).withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.lit(1000003).cast("long"))
    again = langid.fit(changed.unionByName(extra).unionByName(changed.limit(3).withColumn("doc_id", F.lit(None).cast("long"))))
    assert again.labels == model.labels and np.array_equal(again.weights, model.weights)
    assert np.array_equal(again.idf, model.idf) and again.temperature == model.temperature


def test_weights_are_sparse_and_splits_agree(spark, model):
    assert (model.weights == 0).mean() > 0.5
    ids = spark.range(50).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids)


def test_blocks_do_not_change_the_counts(monkeypatch):
    text = "Él niño, 12 straße!! été  x" * 40 + "ǅ日本"
    whole = langid.counts(text)
    for size in (1, 2, 3, 7, 50):
        monkeypatch.setattr(langid, "BLOCK_CHARS", size)
        assert np.array_equal(langid.counts(text), whole)
    assert langid.counts("12 !!") is None and langid.counts("") is None and langid.counts(None) is None


def test_odd_texts_and_empty_tables(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 ...", "x"), (4, "the and of with", "x"), (4, "the and of with", "x"), (None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = langid.predict(df, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in found.collect()}
    assert got[1, None] == got[2, ""] == got[3, "123 ..."] == ("und", 0.0)
    assert got[4, "the and of with"][0] == "en" and found.count() == len(rows)
    nothing = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}
    one = langid.fit(spark.createDataFrame([(i, "abc", "aa") for i in range(9)], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.predict(df, one).collect()} == {"und", "aa"}


def test_temperature_calibrates():
    picks = np.random.default_rng(0)
    logits = picks.normal(size=(4000, 3))
    p = langid.softmax(logits)
    labels = np.array([picks.choice(3, p=q) for q in p])
    assert abs(langid.fit_temperature(logits * 5, labels) - 5) < 0.5


# ---- quality ----

def words(text):
    raw = (text or "").encode().lower().split()
    return raw, list(zip(raw, raw[1:], strict=False))


def test_counts_agree_with_counting_words(monkeypatch):
    texts = ["A b a B a", " lead  and\ttrail \n", "x", "", None, "é É", "w " * 500 + "v" * 3000 + " w"]
    for t in texts:
        whole = quality.counts(t)
        single, pairs = words(t)
        assert whole.sum() == len(single) + len(pairs)
        for size in (1, 5, 64):
            monkeypatch.setattr(quality, "BLOCK_BYTES", size)
            assert np.array_equal(quality.counts(t), whole)
        monkeypatch.undo()
    assert np.array_equal(quality.counts("a b a"), quality.counts("A  B\na"))


def test_resampling(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    ratios = quality.fit(documents, good.union(good).union(good.selectExpr("CAST(NULL AS long)")))
    texts = {r.doc_id: r.text for r in documents.collect()}
    wanted = {r.doc_id for r in good.collect()} & set(texts)
    target, raw = (sum(quality.counts(t) for d, t in texts.items() if d in some) for some in (wanted, set(texts)))
    expected = np.log((target + 1) / (target.sum() + quality.BUCKETS)) - np.log((raw + 1) / (raw.sum() + quality.BUCKETS))
    assert np.allclose(ratios, expected)
    found = quality.resample(documents, ratios, 0.8).collect()
    k = math.ceil(0.8 * len(texts))
    order = sorted(found, key=lambda r: (-r.sample_key, r.doc_id))
    assert [r.sample_rank for r in order] == list(range(1, len(texts) + 1))
    assert [r.kept for r in order] == [True] * k + [False] * (len(texts) - k)
    assert all(math.isclose(r.log_ratio, float(quality.counts(texts[r.doc_id]) @ ratios), abs_tol=1e-9) for r in found)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id: r.kept for r in found}
    good_kept = np.mean([kept[d] for d, q in quality_of.items() if q == 1 and d in kept])
    bad_kept = np.mean([kept[d] for d, q in quality_of.items() if q == 0 and d in kept])
    assert good_kept > 0.9 and bad_kept < 0.2


def test_gumbel_noise_has_its_distribution(spark):
    x = np.array([r.g for r in spark.range(20000).select(quality.gumbel(F.col("id")).alias("g")).collect()])
    assert abs(x.mean() - 0.5772) < 0.05 and abs(x.std() - math.pi / math.sqrt(6)) < 0.05


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "", 2), (None, "a b", 3)], "doc_id long, text string, log_ratio int")
    none = quality.fit(df, spark.createDataFrame([], "doc_id long"))
    assert not none.any()
    found = quality.resample(df, none, 0.5).collect()
    assert sorted(r.sample_rank for r in found) == [1, 2, 3, 4] and sum(r.kept for r in found) == 2
    assert quality.resample(df.limit(0), none, 0.5).count() == 0
    with pytest.raises(ValueError):
        quality.resample(df, none, 1.5)
