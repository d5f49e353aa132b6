"""Top-k search against all inner products."""

import random

import numpy as np
import pytest

from wardflow.llm import topk

SCHEMA = "id long, terms array<long>, weights array<long>, score int"


def brute(queries, candidates, k):
    out = set()
    for q, qt, qw in {(q, tuple(t), tuple(w)) for q, t, w in queries if None not in (q, t, w)}:
        query = dict(zip(qt, qw, strict=True))
        found = sorted((-sum(query.get(t, 0) * w for t, w in zip(ts, ws, strict=True)), i)
                       for i, ts, ws in candidates if None not in (i, ts, ws) and i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])}
    return out


def vectors(seed, n, terms, density):
    picks = random.Random(seed)
    out = []
    for i in range(n):
        ts = [t for t in range(terms) if picks.random() < density]
        out.append((i * 3, ts, [picks.choice([-3, -2, -1, 1, 2, 3, 40]) for _ in ts]))
    return out


@pytest.mark.parametrize(("density", "terms"), [(0.9, 12), (0.05, 60), (0.3, 30)])
def test_same_as_brute_force(spark, monkeypatch, density, terms):
    for name, value in (("SHARD_ROWS", 90), ("BLOCK_ROWS", 7), ("STEP", 16)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(terms, 260, terms, density)
    rows += [(901, [], []), (902, [10 ** 12], [5]), (903, None, [1]), (904, [1], None), (None, [1], [1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    asked = [r for r in rows if r[0] is None or r[0] % 15 == 0 or r[0] in (901, 902)]
    found = topk.top_k(df.where("id % 15 = 0 OR id IN (901, 902)"), df, 10)
    assert found.columns == ["query_id", "rank", "id", "score"]
    assert {tuple(r) for r in found.collect()} == brute(asked, rows, 10)


@pytest.mark.parametrize("step", [1, 8, 64])
@pytest.mark.parametrize("kind", [float, object])
def test_pruning_is_exact_and_happens(monkeypatch, step, kind):
    monkeypatch.setattr(topk, "STEP", step)
    rows = vectors(step, 200, 20, 0.4)
    rows += [(1000 + i, [t, 30], [5, 9]) for i, t in enumerate(range(20))]
    rng = np.random.default_rng(step)
    ts = [np.array(r[1], np.int64) for r in rows]
    ws = [np.array(r[2], np.int64) for r in rows]
    shuffled = rng.permutation(len(rows))
    index = topk.Index(np.array([rows[i][0] for i in shuffled]), [ts[i] for i in shuffled],
                       [ws[i] for i in shuffled], kind)
    asked = [(q, t, w) for q, t, w in rows[::7]]
    weights = np.zeros((len(asked), len(index.number)), kind)
    for i, (_, t, w) in enumerate(asked):
        weights[i, np.searchsorted(index.number, t)] = w
    work = topk.Work()
    scores, places = topk.search(index, np.array([r[0] for r in asked]), weights, 5, work)
    for i, row in enumerate(asked):
        found = sorted((-int(s), int(index.ids[p])) for s, p in zip(scores[i], places[i], strict=True))
        assert {(row[0], n + 1, d, -s) for n, (s, d) in enumerate(found)} == brute([row], rows, 5)
    assert work.skipped and work.probed and work.dropped


def test_few_rows_ties_repeats_and_large_weights(spark):
    big = 1 << 40
    rows = [(1, [0], [big]), (2, [0], [big]), (3, [0], [big + 1]), (4, [0], [-big]), (4, [0], [-big])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    low, high = -(1 << 63), (1 << 63) - 1
    found = [tuple(r) for r in topk.top_k(df.where("id = 1"), df, 9).orderBy("rank").collect()]
    assert found == [(1, 1, 2, high), (1, 2, 3, high), (1, 3, 4, low), (1, 4, 4, low)] or found == [
        (1, 1, 3, high), (1, 2, 2, high), (1, 3, 4, low), (1, 4, 4, low)]
    small = spark.createDataFrame([(i, [0], [1], 0) for i in (1, 2, 3, 3)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(small.where("id = 1"), small, 2).orderBy("rank").collect()] == [
        (1, 1, 2, 1), (1, 2, 3, 1)]
    assert topk.top_k(df.limit(0), df, 3).count() == 0 == topk.top_k(df, df.limit(0), 3).count()
