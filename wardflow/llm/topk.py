"""Exact top-k search over sparse integer vectors by MaxScore.

Candidates are dealt out to shards, queries to blocks; every task holds one shard's inverted
index and one block of queries. Terms of a query are ordered by the most they can add in the
shard. While the k-th score is beyond what the weakest terms can add together, those are
non-essential: only the others' postings are traversed, and the rest is probed for documents
that are still competitive. The shards' best k meet in a window at the end.

The postings of all queries of a block are traversed together: the essential weights of the
block, one row per query, times a run of documents. Postings that few documents have are kept
as lists, those of frequent terms as columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 1 << 14  # candidates that a task holds
BLOCK_ROWS = 1 << 12  # queries that a task answers
STEP = 1024           # documents between two looks at the k-th scores
DENSE = 0.25          # share of documents from which a term's postings are kept as a column
EXACT = float(1 << 53)
BLOCK_CELLS = 1 << 20  # scores that are held at a time
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Index:
    """Postings of one shard, documents in the order of their ids. ``kind`` is the type that holds
    every score exactly: float, or object (whole numbers of any size)."""

    def __init__(self, ids: np.ndarray, terms: list[np.ndarray], weights: list[np.ndarray], kind: type = float) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.kind = ids[order], kind
        sizes = np.array([len(terms[i]) for i in order], np.int64)
        docs = np.repeat(np.arange(len(ids)), sizes)
        none = [np.zeros(0, np.int64)]
        flat = np.concatenate([terms[i] for i in order] or none)
        impact = np.concatenate([weights[i] for i in order] or none)
        self.number, at = np.unique(flat, return_inverse=True)
        by_term = np.lexsort((docs, at))
        docs, impact, at = docs[by_term], impact[by_term], at[by_term]
        ends = np.searchsorted(at, np.arange(len(self.number) + 1))
        spans = [slice(x, y) for x, y in zip(ends, ends[1:], strict=False)]
        self.high = np.array([max(int(impact[s].max()), 0) for s in spans], kind)
        self.low = np.array([min(int(impact[s].min()), 0) for s in spans], kind)
        frequent = [t for t, s in enumerate(spans) if s.stop - s.start >= DENSE * len(ids)]
        self.row = np.full(len(spans), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.columns = np.zeros((len(frequent), len(ids)), kind)
        for r, t in enumerate(frequent):
            self.columns[r, docs[spans[t]]] = impact[spans[t]].astype(kind)
        self.lists = {t: (docs[s], impact[s].astype(kind)) for t, s in enumerate(spans) if self.row[t] < 0}

    def score(self, weights: np.ndarray, a: int, b: int) -> np.ndarray:
        """Scores of the documents a to b: a row per query of ``weights`` (a column per term)."""
        frequent = np.flatnonzero(self.row >= 0)
        out = weights[:, frequent] @ self.columns[self.row[frequent], a:b]
        for t, (docs, impact) in self.lists.items():
            i, j = np.searchsorted(docs, (a, b))
            if i < j and len(asked := np.flatnonzero(weights[:, t])):
                out[np.ix_(asked, docs[i:j] - a)] += np.outer(weights[asked, t], impact[i:j])
        return out

    def probe(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Impacts of pairs of a term and a document."""
        out = np.zeros(len(terms), self.kind)
        dense = self.row[terms] >= 0
        out[dense] = self.columns[self.row[terms[dense]], docs[dense]]
        rare = np.flatnonzero(~dense)
        for t in np.unique(terms[rare]).tolist():
            at = rare[terms[rare] == t]
            there, impact = self.lists[t]
            where = np.minimum(np.searchsorted(there, docs[at]), len(there) - 1)
            hit = there[where] == docs[at]
            out[at[hit]] = impact[where[hit]]
        return out


@dataclass
class Work:
    """What a search has done: terms left out of traversals, pairs probed, pairs dropped there."""

    skipped: int = 0
    probed: int = 0
    dropped: int = 0


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of every row's k greatest, ties to the left, in the order of their positions."""
    n = scores.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > kth
    same = scores == kth
    room = k - above.sum(1, keepdims=True)
    return np.nonzero(above | (same & (np.cumsum(same, axis=1) <= room)))[1].reshape(len(scores), k)


def search(index: Index, own: np.ndarray, weights: np.ndarray, k: int, work: Work | None = None
           ) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of every query's k best documents of a shard (-inf: there are fewer), ties
    to the smaller id; documents with the query's own id are left out. ``weights``: a row per query,
    a column per term of the shard."""
    work = work or Work()
    n, (queries, terms) = len(index.ids), weights.shape
    bounds = np.maximum(weights * index.high, weights * index.low)
    order = np.argsort(bounds, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(terms), order.shape), 1)
    # What the weakest terms up to each can add together.
    reach = np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)
    scores, places = np.zeros((queries, 0), index.kind), np.zeros((queries, 0), np.int64)
    worst = np.full(queries, -np.inf).astype(index.kind)
    a = 0
    while a < n:
        b = min(n, a + min(STEP, max(1, BLOCK_CELLS // queries)))
        # Documents come in the order of their ids, so one with the k-th score is not competitive.
        # Below zero also documents without any of the terms are: then all terms are essential.
        weak = ((reach <= worst[:, None]) & (worst >= 0)[:, None]).sum(1)
        essential = weights.copy()
        essential[rank < weak[:, None]] = 0
        part = index.score(essential, a, b)
        rest = np.where(weak > 0, np.take_along_axis(reach, np.maximum(weak - 1, 0)[:, None], 1)[:, 0], 0) if terms else 0
        open_ = part + np.reshape(rest, (-1, 1)) > worst[:, None]
        _leave_own(open_, index.ids[a:b], own)
        q, d = np.nonzero(open_)
        found, left = part[q, d], weak[q]
        work.skipped += int(weak.sum())
        while len(here := np.flatnonzero(left > 0)):
            # The strongest of each pair's terms that are left.
            term = order[q[here], left[here] - 1]
            work.probed += len(here)
            found[here] += weights[q[here], term] * index.probe(term, d[here] + a)
            left[here] -= 1
            more = np.where(left > 0, reach[q, np.maximum(left - 1, 0)], 0)
            keep = found + more > worst[q]
            work.dropped += int((~keep).sum())
            q, d, found, left = q[keep], d[keep], found[keep], left[keep]
        keep = found > worst[q]
        fresh = np.full((queries, b - a), -np.inf).astype(index.kind)
        fresh[q[keep], d[keep]] = found[keep]
        scores = np.concatenate([scores, fresh], axis=1)
        places = np.concatenate([places, np.broadcast_to(np.arange(a, b), (queries, b - a))], axis=1)
        best = _best(scores, k)
        scores, places = np.take_along_axis(scores, best, 1), np.take_along_axis(places, best, 1)
        if scores.shape[1] == k:
            worst = scores.min(1)
        a = b
    return scores, places


def _leave_own(open_: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
    """Clears the pairs of a query and a document (ids ascending) with one id."""
    low, high = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
    for i in np.flatnonzero(high > low).tolist():
        open_[i, low[i]:high[i]] = False


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_: str = "id", terms: str = "terms",
          weights: str = "weights") -> DataFrame:
    """query_id, rank (from 1), id, score: each query's k best candidates by inner product.

    Both sides have an id (long), distinct terms (array<long>) and their weights (array<long>,
    signed). All candidates but those with the query's own id take part, also with scores of
    zero and less; fewer than k are all returned. Ties go to the smaller id. Rows with a null in
    any of the three columns take no part; empty vectors score zero; repeated candidates count
    each, repeated queries once. Scores beyond a long are cut to its range.
    """
    def rows(df: DataFrame) -> DataFrame:
        cols = [df[id_].cast("long").alias("id"), df[terms].cast("array<long>").alias("terms"),
                df[weights].cast("array<long>").alias("weights")]
        out = df.select(*cols)
        return out.where(" AND ".join(f"{c} IS NOT NULL" for c in out.columns))

    asked = rows(queries).dropDuplicates()
    held = rows(candidates)
    shards = max(1, -(-held.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = held.withColumn("shard", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int"))
    held = held.withColumn("block", every(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", every(shards))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "score": [], "id": []}, dtype=np.int64)
        ts, ws = ([np.asarray(x, np.int64) for x in left[c]] for c in ("terms", "weights"))
        qs, qws = ([np.asarray(x, np.int64) for x in right[c]] for c in ("terms", "weights"))
        # The product of absolute values bounds every sum on the way to a score.
        most = max(float(np.abs(w.astype(float)).sum()) for w in ws)
        kind = float if most * max(float(np.abs(w.astype(float)).max(initial=0)) for w in qws) < EXACT else object
        index = Index(left["id"].to_numpy(np.int64), ts, ws, kind)
        own, out = right["id"].to_numpy(np.int64), []
        size = max(1, BLOCK_CELLS // max(1, len(index.number)))
        for at in range(0, len(own), size):
            weights = np.zeros((len(own[at:at + size]), len(index.number)), kind)
            for i, (t, w) in enumerate(zip(qs[at:at + size], qws[at:at + size], strict=True)):
                where = np.minimum(np.searchsorted(index.number, t), max(len(index.number) - 1, 0))
                known = index.number[where] == t if len(index.number) else np.zeros(len(t), bool)
                weights[i, where[known]] = w[known].astype(kind)
            scores, places = search(index, own[at:at + size], weights, k)
            q, c = np.nonzero(scores != -np.inf)
            cut = [min(max(int(x), LOW), HIGH) for x in scores[q, c].tolist()] if kind is object else scores[q, c]
            out.append(pd.DataFrame({"query_id": own[at:at + size][q], "score": np.asarray(cut, np.int64),
                                     "id": index.ids[places[q, c]]}))
        return pd.concat(out)

    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, score long, id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
