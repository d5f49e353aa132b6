"""Quality selection by importance resampling.

Two generative models over hashed word 1- and 2-grams are counted over all documents: one of the
target (documents labelled good), one of the raw corpus. A document's log ratio of the two,
plus Gumbel noise from its key, is its sampling key; the k documents with the greatest keys are
a sample without replacement with weights proportional to the ratios.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.llm import bloom
from wardflow.operators.index import distributed_index

BUCKETS = 10_000         # of the hashed n-grams
BLOCK_BYTES = 1 << 20    # of a text that are counted at a time
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _A, np.uint64))


_POWER = _powers(1024)


def _word_hashes(raw: bytes) -> np.ndarray:
    """A hash of every word between ASCII white space."""
    points = np.frombuffer(raw, np.uint8)
    inside = ~_SPACE[points]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = np.flatnonzero(start)
    if not len(begins):
        return np.zeros(0, np.uint64)
    # Place of every byte in its word; bytes before the first word are white space anyway.
    at = np.arange(len(points)) - np.concatenate([
        np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(begins, append=len(points)))])
    value = np.where(inside, (points.astype(np.uint64) + np.uint64(1)) * _POWER[at % len(_POWER)], np.uint64(0))
    h = np.add.reduceat(value, begins)
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


def counts(text: str | None) -> np.ndarray:
    """Occurrences of each hashed 1- and 2-gram of the whole text, A-Z lower-cased."""
    out = np.zeros(BUCKETS, np.int64)
    raw, last = (text or "").encode("utf-8", "replace").lower(), np.zeros(0, np.uint64)
    at = 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        words = _word_hashes(raw[at:end])
        chain = np.concatenate([last, words])
        pairs = (chain[:-1] * _C) ^ chain[1:]
        for h in (words, (pairs ^ (pairs >> np.uint64(31))) * _B):
            out += np.bincount((h >> np.uint64(32)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
        last, at = chain[-1:], end
    return out


def _totals(docs: DataFrame) -> np.ndarray:
    """Counts over all texts; every task adds its own up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                out += counts(t.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(out)], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    for bucket, n in docs.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def fit(docs: DataFrame, target_keys: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratio of target and raw probability of every bucket, both smoothed by one count.

    ``target_keys``: one column, the keys of the target documents (nulls ignored, repeats count
    once). All documents are the raw corpus. Without target documents all ratios are zero.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    wanted = scratch.materialise(
        target_keys.toDF("key").where("key IS NOT NULL").distinct(), "quality-target")
    # Texts are counted where they are read: first all that pass a Bloom filter of the target's
    # keys, then the few strangers among them, which are taken off again. No text of the target
    # is moved.
    maybe = bloom.possible(rows, F.col("key"), bloom.build(wanted, "key", wanted.count()))
    strangers = scratch.materialise(
        maybe.select("key").join(wanted, "key", "left_anti").distinct(), "quality-strangers")
    passed = bloom.possible(rows, F.col("key"), bloom.build(strangers, "key", strangers.count()))
    target = _totals(maybe.select("text")) - _totals(passed.join(strangers, "key").select("text"))
    if not target.sum():
        return np.zeros(BUCKETS)
    raw = _totals(rows.select("text"))
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def gumbel(key: Column, seed: str = "gumbel") -> Column:
    """Noise from the key alone: a row's is the same in every run."""
    uniform = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def resample(docs: DataFrame, ratios: np.ndarray, share: float, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, log_ratio, sample_key, sample_rank (from 1), kept.

    The ``share`` of all rows (rounded up) with the greatest sample_key is kept. Null and empty
    texts have log ratio zero. Equal sample keys are ranked by key, then arbitrarily; repeated
    rows are ranked one by one. Other columns play no part.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    sent = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = T.StructType([T.StructField("_key", docs.schema[key].dataType), T.StructField("log_ratio", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [float(counts(t.as_py()) @ sent.value) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(found, pa.float64())], names=schema.names)

    scored = docs.select(docs[key].alias("_key"), docs[text].alias("_text")).mapInArrow(run, schema)
    scored = scratch.materialise(scored.withColumns({
        "sample_key": F.col("log_ratio") + gumbel(F.col("_key")), "_row": F.monotonically_increasing_id()}), "quality")
    k = math.ceil(share * scored.count())
    ranked = distributed_index(scored.withColumn("_down", -F.col("sample_key")), ["_down", "_key", "_row"], "_rank")
    return ranked.select(F.col("_key").alias(key), "log_ratio", "sample_key",
                         (F.col("_rank") + 1).alias("sample_rank"), (F.col("_rank") < k).alias("kept"))
