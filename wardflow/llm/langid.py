"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams of the whole text, weighted by TF-IDF. Document
frequencies are counted over all documents that may be learnt from; the weights are fitted on a
bounded sample of them by follow-the-regularised-leader with an elastic net, so most weights
are exactly zero; a temperature is then fitted on rows of the sample that were set aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.bpe import char_classes

BUCKETS = 1 << 14       # of the hashed n-grams
LONGEST = 3             # characters of an n-gram
SAMPLE_PER_LABEL = 800  # rows that weights and temperature are fitted on, about, per label
MAX_LABELS = 1000       # a check: more different labels are refused
BLOCK_CHARS = 1 << 20   # characters that are counted at a time
UNKNOWN = "und"
_LETTER = 2
_SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def counts(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole text; None without any letter.

    Letters are lower-cased; every run of other characters is one space.
    """
    if not text:
        return None
    out, letters, held = np.zeros(BUCKETS, np.int64), False, np.zeros(0, np.uint64)
    for at in range(0, len(text), BLOCK_CHARS):
        points = np.frombuffer(text[at:at + BLOCK_CHARS].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = char_classes(max(10, int(points.max()).bit_length()))[points] == _LETTER
        letters |= bool(letter.any())
        plain = np.where(letter, points, 32).astype(np.uint64)
        gap = ~letter
        gap[1:] &= ~letter[:-1]
        gap[0] &= not len(held) or held[-1] == 32
        plain = plain[~gap]
        # An n-gram belongs to the block that its last character is in.
        joined, known = np.concatenate([held, plain]), len(held)
        for n in range(1, LONGEST + 1):
            if len(joined) < n:
                continue
            h = np.zeros(len(joined) - n + 1, np.uint64)
            for k in range(n):
                h = (h ^ joined[k:len(joined) - n + 1 + k]) * _SPREAD[k]
            h = (h ^ (h >> np.uint64(29))) * _SPREAD[n % 3]
            fresh = h[max(0, known - n + 1):]
            out += np.bincount((fresh >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
        held = joined[-(LONGEST - 1):]
    return out if letters else None


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray       # per bucket
    weights: np.ndarray   # label x (bucket, then bias)
    temperature: float

    def features(self, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tfidf(count, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Label and calibrated probability; ties go to the first label."""
        count = counts(text)
        if count is None or not self.labels:
            return UNKNOWN, 0.0
        at, x = self.features(count)
        p = softmax((self.weights[:, at] @ x) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def tfidf(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a vector of length one, and of the bias behind it."""
    at = np.flatnonzero(count)
    x = (1 + np.log(count[at])) * idf[at]
    return np.append(at, BUCKETS), np.append(x / np.sqrt((x * x).sum()), 1.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, rate: float = 0.5,
                smooth: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 3,
                seed: int = 7) -> np.ndarray:
    """FTRL-proximal, a learning rate per coordinate, one example at a time."""
    z = np.zeros((n_labels, BUCKETS + 1))
    n = np.zeros_like(z)
    shuffled = np.random.default_rng(seed)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((smooth + np.sqrt(n)) / rate + l2)

    for _ in range(epochs):
        for i in shuffled.permutation(len(rows)):
            at, x, label = rows[i]
            zs, ns = z[:, at], n[:, at]
            w = weights(zs, ns)
            error = softmax(w @ x)
            error[label] -= 1
            g = np.outer(error, x)
            more = ns + g * g
            z[:, at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / rate * w
            n[:, at] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        if loss(a) < loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def held_out(key: Column) -> Column:
    """crc32 of the key as text, modulo 4, is 2; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        sample_per_label: int = SAMPLE_PER_LABEL) -> Model:
    """A model of the rows that are not held out and have a key and a label."""
    learn = docs.select(docs[key].alias("key"), docs[text].alias("text"), docs[label].alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("key")))
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().limit(MAX_LABELS + 1).collect()}
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    labels = sorted(sizes)
    if not labels:
        return Model([], np.ones(BUCKETS), np.zeros((0, BUCKETS + 1)), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for t in batch.column("text"):
                if (c := counts(t.as_py())) is not None:
                    seen += c > 0
                    total += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))],
                                         names=["bucket", "n"])

    found = dict(learn.select("text").mapInArrow(frequencies, "bucket long, n long")
                 .groupBy("bucket").agg(F.sum("n")).collect())
    total = found.pop(-1, 0)
    seen = np.zeros(BUCKETS)
    seen[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + seen)) + 1

    # A row is in the sample if its hash is under its label's share; no row order is involved.
    share = F.create_map(*[x for k in labels for x in (
        F.lit(k), F.lit(min(1.0, sample_per_label / sizes[k])))])
    draw = F.pmod(F.xxhash64("key", F.lit("langid")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws, labels_, at, n = [], [], [], []
            for k, lab, t in zip(batch.column("draw").to_pylist(), batch.column("label").to_pylist(),
                                 batch.column("text"), strict=True):
                if (c := counts(t.as_py())) is not None:
                    # Only what is not zero is kept: a whole row of counts is long.
                    where = np.flatnonzero(c)
                    draws.append(k)
                    labels_.append(lab)
                    at.append(where.astype(np.int32))
                    n.append(c[where].astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(draws, pa.int64()), pa.array(labels_, pa.string()), pa.array(at, pa.list_(pa.int32())),
                pa.array(n, pa.list_(pa.int32()))], names=["draw", "label", "at", "n"])

    sample = (learn.where(draw < share[F.col("label")])
              .select(F.xxhash64("key", F.lit("fold")).alias("draw"), "label", "text")
              .mapInArrow(vectors, "draw long, label string, at array<int>, n array<int>").toArrow())
    rows = []
    for _, label_, at, n in sorted(_sampled(sample), key=lambda r: (r[0], r[1], r[2].tobytes())):
        count = np.zeros(BUCKETS, np.int64)
        count[at] = n
        rows.append((*tfidf(count, idf), labels.index(label_)))
    aside, used = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    weights = fit_weights(used or aside, len(labels))
    logits = np.array([weights[:, at] @ x for at, x, _ in aside]).reshape(len(aside), len(labels))
    return Model(labels, idf, weights, fit_temperature(logits, np.array([y for *_, y in aside], int)))


def _sampled(sample: pa.Table) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """The rows of the sample, their counts as views of the columns."""
    for batch in sample.to_batches():
        at, n = batch.column("at"), batch.column("n")
        cuts, where, counted = at.offsets.to_numpy(), at.values.to_numpy(), n.values.to_numpy()
        for i, (draw, label) in enumerate(zip(batch.column("draw").to_pylist(), batch.column("label").to_pylist(),
                                              strict=True)):
            part = slice(cuts[i], cuts[i + 1])
            yield draw, label, where[part], counted[part]


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds lang_pred and score (the calibrated probability) from the whole text alone.

    Texts that are null or have no letter get ``und`` and 0.0, and so does every text if the
    model knows no label. ``keep`` names the columns to return (default: all).
    """
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in kept), pa.array([x for x, _ in found], pa.string()),
                pa.array([p for _, p in found], pa.float64())], names=[*kept, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
