"""Centroid clustering of whole-number vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it. In
each round only the centroids' distances to the pivots are new. |d(v, p) - d(c, p)| is never
more than d(v, c), so the greatest of these differences over all pivots is a lower bound of
vector and centroid. The centroid with the least bound gives a first exact distance; only those
whose bound does not exceed it are measured too, in whole numbers.

Centroids (a parameter's number of them) are all that the driver holds. Vectors stay where they
are stored: a round is one pass without a shuffle but for one row of sums per task and centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import scratch

PIVOTS = 12
PIVOT_SAMPLE = 256  # vectors of the least hashes among which the pivots are chosen
MOST = 1 << 26      # greatest size of a component: squared distances then fit a long
SLICE = 4096        # vectors that are compared at a time
# Bounds are differences of rounded roots; they are made smaller by more than the rounding.
SLACK = 1e-9


@dataclass
class Clusters:
    """``rows``: key, cluster (int), distance (long, squared). ``centroids``: one list of whole
    numbers each, in the order of their numbers. ``measured``: exact distances of each round."""

    rows: DataFrame
    centroids: list[list[int]]
    measured: list[int] = field(default_factory=list)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column per point."""
    out = np.empty((len(vectors), len(points)), np.int64)
    for at, p in enumerate(points):
        gap = vectors - p
        out[:, at] = np.einsum("ij,ij->i", gap, gap)
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: the next has the greatest sum of distances to those chosen."""
    chosen = [0] if len(sample) else []
    total = np.zeros(len(sample))
    while chosen and len(chosen) < min(count, len(sample)):
        total += np.sqrt(squared(sample, sample[chosen[-1:]])[:, 0])
        free = total.copy()
        free[chosen] = -1
        chosen.append(int(free.argmax()))
    return sample[chosen]


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of every vector's nearest centroid (ties: the smaller number),
    and how many distances were measured. ``table``: vectors x pivots, ``to_pivots``: centroids x
    pivots, both as roots."""
    n, k = len(vectors), len(centroids)
    bounds = np.zeros((n, k))
    for p in range(table.shape[1]):
        np.maximum(bounds, np.abs(table[:, p, None] - to_pivots[None, :, p]), out=bounds)
    bounds -= SLACK * (1 + bounds + (table.max(1, initial=0)[:, None]))
    best = bounds.argmin(1)
    gap = vectors - centroids[best]
    distance = np.einsum("ij,ij->i", gap, gap)
    measured, first = n, best.copy()
    for c in range(k):
        open_ = np.flatnonzero((bounds[:, c] <= np.sqrt(distance)) & (first != c))
        if not len(open_):
            continue
        gap = vectors[open_] - centroids[c]
        found = np.einsum("ij,ij->i", gap, gap)
        measured += len(open_)
        nearer = (found < distance[open_]) | ((found == distance[open_]) & (c < best[open_]))
        at = open_[nearer]
        distance[at], best[at] = found[nearer], c
    return best, distance, measured


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _with_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The stored pivot table: id, v, roots of the squared distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            if part.num_rows:
                roots = np.sqrt(squared(_matrix(part.column("v"), np.int64), pivots))
                ends = pa.array(np.arange(len(roots) + 1) * len(pivots), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("v"), pa.ListArray.from_arrays(ends, pa.array(roots.ravel()))],
                    names=["id", "v", "p"])

    kind = rows.schema["id"].dataType.simpleString()
    return scratch.materialise(rows.mapInArrow(run, f"id {kind}, v array<int>, p array<double>"), "laesa")


def start_centroids(spark: SparkSession, rows: DataFrame, hashed: F.Column, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes, ascending; equal hashes by the vector."""
    held = rows.select(hashed.alias("h"), "v").where("h IS NOT NULL").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in held], np.int64)


def cluster(vectors: DataFrame, k: int, rounds: int, key: str = "id", vector: str = "vector",
            seed: str = "0", pivots: int = PIVOTS) -> Clusters:
    """Lloyd's rounds in whole numbers over all rows with a vector.

    ``vector`` is an array of whole numbers; null vectors and those with a null take no part, all others must
    have the same length. Components beyond +-2^26 end the job with an error, because squared
    distances would not fit a long. Centroids start as the k vectors with the smallest SHA-256 of
    ``<seed>:<key>``, in that order (null keys have no hash and start nothing; without any key
    there are no centroids and no rows). Every round assigns all vectors to the nearest centroid,
    ties to the smaller number, and replaces each centroid that has vectors by their
    componentwise floor(sum / count). At the end they are assigned once more. Repeated rows count
    each. Fewer vectors than k give as many centroids. Other columns play no part.
    """
    spark = vectors.sparkSession
    v = vectors[vector]
    rows = vectors.select(vectors[key].alias("id"), v.alias("v")).where(
        v.isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    rows = rows.withColumn("v", F.when(
        F.exists("v", lambda x: (x > MOST) | (x < -MOST)),
        F.raise_error(F.lit(f"a component is beyond {MOST}"))).otherwise(F.col("v").cast("array<int>")))
    hashed = lambda s: F.sha2(F.concat(F.lit(f"{s}:"), F.col("id").cast("string")), 256)
    found = start_centroids(spark, rows, hashed(seed), k)
    if not len(found):
        empty = rows.limit(0).select(F.col("id").alias(key), F.lit(0).alias("cluster"),
                                     F.lit(0).cast("long").alias("distance"))
        return Clusters(empty, [])
    fixed = choose_pivots(start_centroids(spark, rows, hashed("pivot"), PIVOT_SAMPLE), pivots)
    stored = _with_table(rows, fixed)
    measured = []
    for _ in range(rounds):
        found, count = _moved(stored, found, fixed)
        measured.append(count)
    last = _assigned(stored, found, fixed)
    return Clusters(last.withColumnRenamed("id", key), found.tolist(), measured)


def _moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after one round; one row of sums per task and centroid is moved."""
    k, width = centroids.shape
    shared = stored.sparkSession.sparkContext.broadcast((centroids, np.sqrt(squared(centroids, pivots))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, roots = shared.value
        sums, counts, measured = np.zeros((k, width), np.int64), np.zeros(k, np.int64), 0
        for part in _slices(batches):
            if not part.num_rows:
                continue
            vs = _matrix(part.column("v"), np.int64)
            best, _, n = nearest(vs, _matrix(part.column("p"), float), points, roots)
            measured += n
            counts += np.bincount(best, minlength=k)
            for c in np.unique(best).tolist():
                sums[c] += vs[best == c].sum(0)
        here = np.flatnonzero(counts)
        ends = pa.array(np.arange(len(here) + 1) * width, pa.int32())
        share = np.zeros(len(here), np.int64)
        share[:1] = measured
        yield pa.RecordBatch.from_arrays(
            [pa.array(here, pa.int32()), pa.array(counts[here]), pa.array(share),
             pa.ListArray.from_arrays(ends, pa.array(sums[here].ravel()))], names=["c", "n", "measured", "s"])

    parts = stored.select("v", "p").mapInArrow(run, "c int, n long, measured long, s array<long>")
    total = parts.groupBy("c").agg(F.sum("n").alias("n"), F.sum("measured").alias("measured"),
                                   F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))
    moved, measured = centroids.copy(), 0
    for r in total.collect():  # at most k rows
        moved[r.c] = [x // r.n for x in r.s]
        measured += r.measured
    return moved, measured


def _assigned(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast((centroids, np.sqrt(squared(centroids, pivots))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, roots = shared.value
        for part in _slices(batches):
            if part.num_rows:
                best, distance, _ = nearest(_matrix(part.column("v"), np.int64), _matrix(part.column("p"), float),
                                            points, roots)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                    names=["id", "cluster", "distance"])

    kind = stored.schema["id"].dataType.simpleString()
    return scratch.materialise(stored.mapInArrow(run, f"id {kind}, cluster int, distance long"), "laesa-assigned")
