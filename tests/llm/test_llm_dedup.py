"""Exact dedup, SimHash classes and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardflow.llm import exact_dedup, simhash
from wardflow.llm.components import connected

NULL_LAST = (1, 0)


def order(key):
    return (0, key) if key is not None else NULL_LAST


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)), key=order) if not isinstance(a, int) else sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


DOCS = [(5, "a b c"), (3, "abc "), (9, " a  b\tc\n\x0b\x0c\r"), (4, "ABC"), (7, None), (2, ""), (8, " \n"), (1, "a bc"),
        (None, "x y"), (None, "xy"), (6, "xy"), (11, "q"), (11, "q"), (12, "z" * 300), (13, "z" * 299 + "y"), (14, "z" * 300),
        (None, "only null"), (None, "only null")]


def brute(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), order(d), i, d))
    out = []
    for text, members in groups.items():
        best = min(members)
        out += [(d, best[3], len(members), i == best[2], hashlib.sha256(text.encode()).hexdigest())
                for _, _, i, d in members]
    return sorted(out, key=str)


def test_exact_dedup(spark):
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in DOCS], "doc_id long, text string, _key string, kept int")
    found = exact_dedup.exact_dedup(df)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_hash"]
    assert sorted(((*r[:4], bytes(r[4]).hex()) for r in found.collect()), key=str) == brute(DOCS)
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_drop_copies(spark):
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(DOCS)], "doc_id long, text string, _hash int")
    found = exact_dedup.drop_copies(df)
    assert found.columns == df.columns
    expected = sorted(((d, len(h)) for d, _, _, kept, h in brute(DOCS) if kept), key=str)
    assert sorted(((r.doc_id, 64) for r in found.collect()), key=str) == expected
    distinct = df.where("doc_id IN (1, 4, 5)")
    assert exact_dedup.drop_copies(distinct).count() == 3


def test_texts_of_one_length_and_prefix_are_told_apart(spark):
    texts = ["p" * exact_dedup.PREFIX_CHARS + end for end in ("a", "b", "a", "c")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(exact_dedup.exact_dedup(df).select("doc_id", "keep_id").collect()) == [(0, 0), (1, 1), (2, 0), (3, 3)]


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks, picks = simhash.masks(radius), random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        flip = sum(1 << b for b in picks.sample(range(64), radius))
        assert any(not m & flip for m in masks)
    assert min(m.bit_count() for m in masks) >= 30


def plain_fingerprint(text, words=3):
    parts = [w for w in re.split("[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    picks = random.Random(2)
    out = [None, "", " \n", "one", "One", "one two", "one two three", "ÉCOLE École x", "a b c d"]
    for _ in range(30):
        words = [f"w{picks.randrange(40)}" for _ in range(picks.choice([3, 40, 200]))]
        for _ in range(4):
            out.append(" ".join(words))
            words[picks.randrange(len(words))] = f"v{picks.randrange(9)}"
    return out


def test_fingerprints():
    for t in near_texts():
        assert simhash.fingerprint(t) == plain_fingerprint(t)
        assert simhash.fingerprint(t, 5) == plain_fingerprint(t, 5)


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BUCKET", block)
    rows = [(100 - i, t) for i, t in enumerate(near_texts())] + [(100, None), (None, "one"), (3, "completely different")]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, fingerprint int").withColumn("_k", F.lit(1))
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = union_find(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root[i]] = min([x for x in (least.get(root[i]), d) if x is not None], default=None)
    expected = sorted((str(d), prints[i], least[root[i]]) for i, (d, _) in enumerate(rows))
    found = simhash.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint % (1 << 64), r.component_id) for r in found) == expected
    assert {r.component_id for r in found if r.kept} == set(least.values())
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == len(least)


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0 == simhash.drop_near_copies(df).count()


def test_dense_groups_give_a_forest():
    picks = random.Random(4)
    base = picks.getrandbits(64)
    fps = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    signed = np.array(sorted(fps), np.uint64).view(np.int64)
    assert len(simhash._forest(signed, 3)) == len(fps) - 1


def test_components(spark):
    picks = random.Random(8)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(picks.randrange(60), picks.randrange(60)) for _ in range(35)]
    df = spark.createDataFrame([*pairs, (None, 3), (4, None), (5, 5), pairs[0], pairs[0][::-1]], "a long, b long")
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    expected = union_find(nodes, [p for p in pairs if p[0] != p[1]])
    assert {r.node: r.root for r in connected(df).collect()} == expected
    assert connected(df.limit(0)).count() == 0


def test_drop_copies_hashes_in_full_only_rows_that_may_be_in_a_group(spark, monkeypatch):
    hashed = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(text):
        hashed.add(1)
        return hashlib.sha256(text.encode()).digest()
    monkeypatch.setattr(exact_dedup, "full_hash", counted)
    df = spark.createDataFrame([(i, f"text {max(i, 1)} {'x' * i}") for i in range(300)] + [(300, "text 5 xxxxx")],
                               "doc_id long, text string")
    assert exact_dedup.drop_copies(df).count() == 300
    assert hashed.value < 50


def test_rows_repeated_as_a_whole_are_not_gathered_by_a_window(spark):
    df = spark.createDataFrame([(7, "same")] * 400 + [(100 + i, f"text {i}") for i in range(200)], "doc_id long, text string")
    for found, n in ((exact_dedup.exact_dedup(df).where("kept"), 201), (exact_dedup.drop_copies(df), 201)):
        assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == n == found.select("doc_id").distinct().count()
