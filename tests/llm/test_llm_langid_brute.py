"""The language query against a plain version: loops over characters, dense weights, one example at a time."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from wardflow.llm import langid
from wardflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def plain_counts(text):
    if not text or not any(c.isalpha() for c in text):
        return None
    kept = []
    for c in text.lower():
        if c.isalpha():
            kept.append(ord(c))
        elif kept and kept[-1] != 32:
            kept.append(32)
    out = np.zeros(langid.BUCKETS)
    for n in (1, 2, 3):
        for at in range(len(kept) - n + 1):
            h = 0
            for k in range(n):
                h = (h ^ kept[at + k]) * SPREAD[k] & MASK
            h = (h ^ h >> 29) * SPREAD[n % 3] & MASK
            out[h >> 50] += 1
    return out


def test_counts_equal_plain_ones():
    for text in ("", "12 !", "Ação  é 3x, não?", "  a b", "Straße ﬁn\n\nΣΑΣ", None):
        found, expected = langid.counts(text), plain_counts(text)
        assert (found is None) == (expected is None)
        assert found is None or (found == expected).all()


def softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return np.array([v / sum(e) for v in e])


def test_query_equals_a_plain_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("doc_id", F.lit("fold")).alias("fold")).collect()
    counted = {r.doc_id: plain_counts(r.text) for r in rows}
    learn = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None]
    labels = sorted({r.lang for r in learn})
    assert all(sum(r.lang == x for r in learn) <= langid.SAMPLE_PER_LABEL for x in labels)  # the sample is all
    learn = [r for r in learn if counted[r.doc_id] is not None]
    seen = sum((counted[r.doc_id] > 0).astype(float) for r in learn)
    idf = np.log((1 + len(learn)) / (1 + seen)) + 1

    def features(count):
        x = np.where(count > 0, (1 + np.log(np.maximum(count, 1))) * idf, 0.0)
        return np.append(x / math.sqrt(float(x @ x)), 1.0)

    learn.sort(key=lambda r: (r.fold, r.lang))
    examples = [(features(counted[r.doc_id]), labels.index(r.lang)) for r in learn]
    aside, used = examples[::5], [e for i, e in enumerate(examples) if i % 5]

    # Follow the regularised leader, every coordinate of every label each time.
    rate, smooth, l1, l2 = 0.5, 1.0, 0.02, 0.05
    z, n = (np.zeros((len(labels), langid.BUCKETS + 1)) for _ in range(2))

    def weights():
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((smooth + np.sqrt(n)) / rate + l2))

    order = np.random.default_rng(7)
    for _ in range(3):
        for i in order.permutation(len(used)):
            x, y = used[i]
            w = weights()
            p = softmax((w @ x).tolist())
            for label in range(len(labels)):
                g = (p[label] - (label == y)) * x
                z[label] += g - (np.sqrt(n[label] + g * g) - np.sqrt(n[label])) / rate * w[label]
                n[label] += g * g
    w = weights()

    def loss(log_t):
        return -sum(math.log(max(softmax((w @ x / math.exp(log_t)).tolist())[y], 1e-12)) for x, y in aside)

    low, high = math.log(0.02), math.log(20.0)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    temperature = math.exp((low + high) / 2)

    found = {r.doc_id: r for r in QUERIES["op8_langid"](spark, FOLDER).collect()}
    assert set(found) == set(counted)
    for d, count in counted.items():
        if count is None:
            assert (found[d].lang_pred, found[d].score) == ("und", 0.0)
            continue
        p = softmax((w @ features(count) / temperature).tolist())
        assert found[d].lang_pred == labels[int(p.argmax())]
        assert math.isclose(found[d].score, p.max(), abs_tol=2e-3)
