"""Labels kept between runs, and lexicons learnt from labelled texts."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardflow.functions import text as X
from wardflow.operators import label_store, phrases, weights

LEXICON = {"dor": {"dor": 1.0}, "ar": {"ar": 2.0}}


def stored(spark, root, definition):
    return [spark.read.parquet(p).count() for p in label_store.batches(spark, root, definition)]


def length_of(texts):
    return texts.withColumn("tamanho", F.length("t"))


def test_only_new_texts_are_labelled(spark, rows, tmp_path):
    root = str(tmp_path)
    called = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def count(text):
        called.add(1)
        return len(text)

    def add(texts):
        return texts.withColumn("tamanho", count("t"))

    first = spark.createDataFrame([(1, "dor"), (2, "ar"), (3, "dor"), (4, None)] * 2, "id int, t string")
    found = label_store.labelled(first, "t", root, "n", add)
    assert rows(found) == rows(first.withColumn("tamanho", F.length("t"))) and called.value == 2
    second = spark.createDataFrame([(9, "ar"), (1, "novo"), (1, "")], "id int, t string")
    found = label_store.labelled(second, "t", root, "n", add)
    assert rows(found) == [(1, "", 0), (1, "novo", 4), (9, "ar", 2)] and called.value == 4
    label_store.labelled(first.unionByName(second), "t", root, "n", add).collect()
    assert called.value == 4 and sorted(stored(spark, root, "n")) == [2, 2]
    label_store.labelled(first, "t", root, "another rule", add)
    assert called.value == 6


def test_a_batch_without_its_mark_does_not_count(spark, rows, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([(1, "dor")], "id int, t string")
    label_store.labelled(docs, "t", root, "n", length_of)
    folder = label_store.batches(spark, root, "n")[0].removeprefix("file:")
    import os
    os.remove(f"{folder}/_SUCCESS")
    assert label_store.batches(spark, root, "n") == []
    assert rows(label_store.labelled(docs, "t", root, "n", length_of)) == [(1, "dor", 3)]
    # Two runs at once may store a text twice: it still has one label.
    open(f"{folder}/_SUCCESS", "w").close()
    assert len(label_store.batches(spark, root, "n")) == 2
    assert rows(label_store.labelled(docs, "t", root, "n", length_of)) == [(1, "dor", 3)]
    none = label_store.labelled(docs.limit(0), "t", root, "m", length_of)
    assert none.columns == ["id", "t", "tamanho"] and none.count() == 0


def test_rules_are_known_by_their_definition(spark, rows, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([(1, "dor e ar"), (2, "nada"), (3, None)], "id int, t string")
    found = label_store.labelled_by_rules(docs, "t", root, {"l": (LEXICON, "x")})
    assert rows(found) == rows(docs.withColumn("l", X.classify(F.col("t"), LEXICON, "x")))
    turned = {"ar": {"ar": 1.0}, "dor": {"dor": 1.0}}
    assert label_store.fingerprint([list(LEXICON.items())]) != label_store.fingerprint([list(turned.items())])
    found = label_store.labelled_by_rules(docs, "t", root, {"l": (turned, "y")})
    assert rows(found) == rows(docs.withColumn("l", X.classify(F.col("t"), turned, "y")))


def plain_weights(texts, prior, least):
    """Weights by counting in Python."""
    bags = [(label, set(t.lower().split())) for t, label in texts if t is not None and label is not None]
    labels = sorted({label for label, _ in bags})
    out = set()
    for place, label in enumerate(labels if len(labels) > 1 else []):
        size = sum(other == label for other, _ in bags)
        for term in set().union(*(b for _, b in bags)):
            n = sum(term in b for other, b in bags if other == label)
            o = sum(term in b for other, b in bags if other != label)
            rest = len(bags) - size
            w = math.log((n + prior) / (size - n + prior)) - math.log((o + prior) / (rest - o + prior))
            if abs(w) >= least * math.sqrt(1 / (n + prior) + 1 / (o + prior)):
                out.add((place, label, term, Decimal(str(round(w, 6))).quantize(Decimal("0.000001")), n))
    return out


@pytest.mark.parametrize("least", [0.0, 1.0, 2.5])
def test_weights_equal_plain_counting(spark, least):
    import random
    rng = random.Random(3)
    texts = [(" ".join(rng.choices(["dor", "sala", "bom", "ruim", "fila"][:2 + i % 4], k=rng.randint(0, 6))),
              rng.choice(["a", "b", "c"])) for i in range(120)]
    texts += [("bom bom", "a")] * 40 + [(None, "a"), ("dor", None), ("", "b")]
    found = weights.learn(spark.createDataFrame(texts, "t string, l string"), "t", "l", least=least)
    assert {tuple(r) for r in found.collect()} == plain_weights(texts, weights.PRIOR, least)


def test_nothing_is_learnt_from_one_label(spark):
    df = spark.createDataFrame([("dor", "a"), ("ar", "a")], "t string, l string")
    for given in (df, df.limit(0)):
        found = weights.learn(given, "t", "l")
        assert found.columns == ["position", "label", "term", "weight", "n"] and found.count() == 0


def test_learnt_weights_find_toxic_texts_that_were_held_out(spark):
    """More of the held-out toxic texts than the word list finds, few clean ones among them."""
    from wardflow.testbed import binding as B
    sf = "/root/testdata/sf0.1"
    marked = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    docs = B.documents(spark, sf).join(marked, "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    lexicon = weights.learn(docs.where(~held), "text", "toxic")
    test = docs.where(held)
    by_list = test.where((F.col("toxic") == 1) & (X.sentiment(F.col("text"), [], B.TOXIC) == "negative")).count()
    found = phrases.classify_by_lexicon(test, "doc_id", "text", lexicon, "0").where("label = '1'")
    hits = test.join(found, "doc_id").groupBy("toxic").count().collect()
    counts = {r.toxic: r["count"] for r in hits}
    assert counts[1] > by_list and counts[1] > 0.75 * test.where("toxic = 1").count()
    assert counts[0] < 0.06 * test.where("toxic = 0").count()


def test_passes_over_the_texts(spark, rows, tmp_path):
    """A new store compares nothing; later runs that need no text back read the texts twice."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    raw = spark.createDataFrame([(i, f"texto {i % 30}") for i in range(100)], "id int, t string")
    docs = raw.withColumn("t", seen.asNondeterministic()("t"))
    label_store.labelled(docs, "t", str(tmp_path), "n", length_of, keep_text=False)
    assert read.value < 200
    read.value = 0
    found = label_store.labelled(docs.withColumn("t", F.concat("t", F.lit("!"))), "t", str(tmp_path), "n", length_of,
                                 keep_text=False)
    assert rows(found) == rows(raw.select("id", (F.length("t") + 1).alias("tamanho")))
    assert read.value <= 200
