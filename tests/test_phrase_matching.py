import random

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from wardflow.functions.text import words
from wardflow.operators import phrases
from wardflow.operators.word_sets import word_sets

LONG = "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "abcdefghabcdefghi", "x" * 300


def _texts(rng, n, base=()):
    """Sets of words, rare and common ones; half of them near copies of earlier ones."""
    made = [list(b) for b in base]
    for i in range(n):
        if made and rng.random() < 0.5:
            old = rng.choice(made)
            made.append([w if rng.random() < 0.85 else f"n{i}w{j}" for j, w in enumerate(old)])
        else:
            size = rng.choice([1, 2, 3, 10, 40, 150])
            made.append(list({f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(size)}))
    return made[len(base):]


def _similar(left, right, threshold):
    """All pairs by brute force."""
    return {(i, j): len(a & b) / len(a | b) for i, a in left.items() for j, b in right.items()
            if len(a & b) / len(a | b) >= threshold}


@pytest.fixture
def written(monkeypatch):
    """Plans of all tables that are written, by path."""
    plans = {}
    write = DataFrameWriter.parquet

    def spy(self, path, *args, **more):
        plans.setdefault(path, []).append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return plans


def test_texts_are_not_moved_to_the_catalogue(spark, written):
    """Neither word sets nor candidates are shuffled where pairs are found: that grows with texts times shards."""
    rng = random.Random(4)
    catalogue = _texts(rng, 60)
    texts = _texts(rng, 120, catalogue)
    left = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, t string")
    right = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(catalogue)], "c int, p string")
    phrases.match_phrases(left, "id", "t", right, "c", "p", 0.6).count()
    plans = [p for path, found in written.items() if "/pairs" in path for p in found]
    assert plans and not any("Exchange hashpartitioning" in p for p in plans)


@pytest.mark.parametrize("threshold", [1e-10, 0.1, 0.6, 0.75, 1.0])
def test_shard_equals_brute_force(threshold):
    rng = random.Random(5)
    catalogue = sorted({frozenset(t) for t in _texts(rng, 300)}, key=lambda s: (len(s), sorted(s)))
    texts = _texts(rng, 200, catalogue)
    number = {w: rng.getrandbits(64) for s in (*catalogue, *texts) for w in s}
    number["last"] = 2**64 - 1
    texts.append(["last"])
    hashed = [np.sort(np.array([number[w] for w in s], np.uint64)) for s in catalogue]
    shard = phrases._Shard(np.concatenate(hashed), np.array([len(h) for h in hashed]), threshold)
    shard.__setstate__(shard.__getstate__())
    found = {}
    for i, text in enumerate(texts):
        one = np.sort(shard.numbers(np.sort(np.array([number[w] for w in set(text)], np.uint64))))
        found |= {(i, int(j)): r for j, r in zip(*shard.similar(one), strict=True)}
    expected = _similar({i: set(t) for i, t in enumerate(texts)}, dict(enumerate(catalogue)), threshold)
    if threshold < 1e-9:  # sets without a common word are never paired
        expected = {k: v for k, v in expected.items() if v > 0}
    assert found == expected


def test_matching_equals_brute_force(spark, monkeypatch):
    """Several shards, blocks and batches of pairs; copies on both sides; keys that are strings, and rows without one."""
    for name, most in (("BLOCK_WORDS", 50), ("SHARD_WORDS", 1500), ("PAIRS_HELD", 2), ("COPIES_SENT", 1)):
        monkeypatch.setattr(phrases, name, most)
    rng = random.Random(6)
    catalogue = _texts(rng, 120)
    texts = _texts(rng, 150, catalogue)
    texts += texts[:20] + [[]]
    right = [(f"c{i:03}", " ".join(t)) for i, t in enumerate(catalogue + catalogue[:10])] + [(None, "w1"), ("z", ""), ("z", None)]
    left = [(f"t{i}", " - ".join(t)) for i, t in enumerate(texts)] + [(None, right[0][1]), ("none", None)]
    found = phrases.match_phrases(spark.createDataFrame(left, "id string, t string"), "id", "t",
                                  spark.createDataFrame(right, "c string, p string"), "c", "p", 0.6).collect()
    classes = {}
    for c, p in right:
        if p:
            classes.setdefault(frozenset(p.split()), []).append(c)
    entries = {min(c for c in held if c): (s, len(held)) for s, held in classes.items() if any(held)}
    expected = _similar({k: set(t.split(" - ")) for k, t in left if k and t},
                        {c: s for c, (s, _) in entries.items()}, 0.6)
    assert sorted(tuple(r) for r in found) == sorted((i, c, entries[c][1], v) for (i, c), v in expected.items())


def test_empty_catalogue(spark):
    texts = spark.createDataFrame([(1, "a b")], "id int, t string")
    assert phrases.match_phrases(texts, "id", "t", texts.where("false"), "id", "t", 0.6).count() == 0


def test_word_sets_have_the_words_of_the_text(spark, monkeypatch):
    """Folding from bytes equals that of the columns, in chunks of any size."""
    from wardflow.operators import word_sets as made

    monkeypatch.setattr(made, "CHUNK_BYTES", 40)
    texts = ["", " ", None, "Ação AÇÃO acao, Être-là; ñ Ñ", "İstanbul 5 KK kelvin Å Ångström", "a", "a" "a", "ab a,b",
             "ß ø œ žluť \U0001f600a\U0001f600 日本a語", "Ã", "xÃ", "é", *LONG, " ".join(LONG), "b a b a", "Á á", "ÿþ×÷a", "0 00 000"]
    # Every place of a word in a chunk, and no word over the end of a text.
    texts += [f"{'q' * i}é{'r' * (i % 11)}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    one = {r["w"]: None for r in df.select(F.explode(words(F.col("t"))).alias("w")).collect()}
    held = spark.createDataFrame([(w,) for w in one], "w string")
    for r in word_sets(held, F.col("w"), F.col("w")).collect():
        assert r["__size"] == 1
        one[r["__key"]] = bytes(r["__words"])
    assert len(set(one.values())) == len(one)
    expected = {r["i"]: sorted({one[w] for w in r["w"]}) for r in df.select("i", words(F.col("t")).alias("w")).collect() if r["w"]}
    signs = {}
    for r in word_sets(df, F.col("i"), F.col("t")).collect():
        hashes = bytes(r["__words"])
        assert sorted(hashes[k:k + 8] for k in range(0, len(hashes), 8)) == expected.pop(r["__key"])
        assert r["__size"] == len(hashes) // 8
        assert signs.setdefault(bytes(r["__sign"]), hashes) == hashes
    assert not expected and len(set(signs.values())) == len(signs)
