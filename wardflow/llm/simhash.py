"""Near-duplicate classes by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits, one vote of all shingles each. For radius r every bit gets a vector
of r + 1 bits, never zero, and every vector v but zero gives a mask: the bits whose vector has
an odd product with v. Any r bits leave a v that is orthogonal to all their vectors, so two
fingerprints that differ in r bits at most agree on that mask and meet in its table: no pair
within the radius is missed. Whether a pair that meets is within the radius is then counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.llm import bloom
from wardflow.llm.components import connected

BITS = 64
BUCKET = 512  # fingerprints of a bucket that one task compares with each other


def masks(radius: int) -> list[int]:
    """The masks of the covering family, as unsigned 64-bit integers."""
    vectors = [i % ((1 << (radius + 1)) - 1) + 1 for i in range(BITS)]
    return [sum(1 << bit for bit, v in enumerate(vectors) if (v & m).bit_count() % 2)
            for m in range(1, 1 << (radius + 1))]


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles: A-Z lower-cased, words between ASCII white space. Fewer
    words are one shingle; none give zero."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    begins = [0, *ends[:-words].tolist()]
    ends = (ends[words - 1:] - 1).tolist() or [len(whole)]
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(ends)
    for at in range(0, n, 1 << 16):  # bounds the memory for very long texts
        h = np.fromiter((digest(whole[a:b], seed) for a, b in
                         zip(begins[at:at + (1 << 16)], ends[at:at + (1 << 16)], strict=False)), np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", words: int = 3,
                 keep: list[str] | None = None) -> DataFrame:
    """Adds ``out``: the fingerprint as a signed long. Null text is empty, its fingerprint
    zero. ``keep`` names the columns to return (default: all)."""
    kept = [c for c in (keep if keep is not None else docs.columns) if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(text)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(found.view(np.int64))], names=[*kept, out])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs within the radius do.

    ``distinct`` has one column, fp, without repeats. A bucket is compared in blocks: a large
    one is dealt out by pairs of its blocks, so that no task holds it whole. Of a block pair
    only a spanning forest is returned: never more links than fingerprints.
    """
    table = F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for i, m in enumerate(masks(radius))])).alias("s")
    rows = distinct.select("fp", table).select("fp", F.col("s.t").alias("t"), F.col("s.k").alias("k"))
    sizes = rows.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    blocks = F.ceil(F.col("n") / BUCKET).cast("int")
    met = rows.join(sizes, ["t", "k"]).withColumn("m", blocks)
    met = met.withColumn("b", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    # Block pair (i, j), i <= j: a fingerprint of block b goes to all pairs with b in them.
    pairs = F.transform(F.sequence(F.lit(0), F.col("m") - 1),
                        lambda o: F.struct(F.least(o, F.col("b")).alias("i"), F.greatest(o, F.col("b")).alias("j")))
    dealt = met.withColumn("p", F.explode(pairs)).select(
        "t", "k", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "b", "fp")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_forest(group["fp"].to_numpy(), radius), columns=["a", "b"])

    return dealt.groupBy("t", "k", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _forest(signed: np.ndarray, radius: int) -> np.ndarray:
    """Links within the radius, by growing trees: each fingerprint is compared with those that
    are not in a tree yet, so dense groups are done after few rounds."""
    fps = np.sort(signed).view(np.uint64)
    found: list[tuple[int, int]] = []
    outside = np.arange(len(fps))
    while len(outside):
        queue, outside = [outside[0]], outside[1:]
        while queue and len(outside):
            at = queue.pop()
            near = np.bitwise_count(fps[outside] ^ fps[at]) <= radius
            for i in outside[near].tolist():
                found.append((fps[at], fps[i]))
                queue.append(i)
            outside = outside[~near]
    return np.array(found, np.uint64).reshape(-1, 2).view(np.int64)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (long), component_id, kept, text_sign.

    Rows are linked if their fingerprints differ in ``radius`` bits at most; component_id is the
    smallest key that can be reached, the row's own included (null only if all keys are null).
    One document of each component is kept: the one with that key (of those, the one with the
    smallest text_sign, the XXH64 of the text); rows repeated as a whole are kept together.
    Texts without a word have fingerprint zero and are linked like any other. Links are between
    fingerprints, so repeated rows and keys do no harm. Other columns play no part.
    """
    rows = scratch.materialise(fingerprints(
        docs.select(docs[key].alias("_key"), F.xxhash64(docs[text]).alias("text_sign"), docs[text].alias("_text")),
        "_text", "fingerprint", words, keep=["_key", "text_sign"]), "simhash")
    # Equal fingerprints are one node, so copies cost nothing from here on.
    first = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("text_sign").alias("s"))
    nodes = scratch.materialise(rows.groupBy("fingerprint").agg(F.min(first).alias("_first")), "simhash-nodes")
    found = scratch.materialise(links(nodes.select(F.col("fingerprint").alias("fp")), radius), "simhash-links")
    return labelled(rows, nodes, connected(found), "fingerprint").select(
        F.col("_key").alias(key), "fingerprint", "component_id", "kept", "text_sign")


def labelled(rows: DataFrame, nodes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """The rows with component_id and kept, by their node, the column ``name``. ``nodes`` has the
    least row of each node as _first, ``roots`` the root of nodes that are linked."""
    rooted = nodes.join(roots.withColumnRenamed("node", "_node"), F.col(name) == F.col("_node"), "left").select(
        name, "_first", F.coalesce("root", name).alias("_root"))
    # Stored, so that the join behind it can split the fingerprints of a large component.
    best = scratch.materialise(rooted.groupBy("_root").agg(F.min("_first").alias("_best")), "simhash-best")
    labels = rooted.join(best, "_root").select(name, "_best")
    return rows.join(labels, name).withColumn("component_id", F.col("_best.k")).withColumn(
        "kept", F.col("_key").eqNullSafe(F.col("_best.k")) & (F.col("text_sign") == F.col("_best.s")))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                     radius: int = 3) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns; of rows repeated as
    a whole one stays."""
    return only_kept(docs, near_duplicates(docs, key, text, words, radius), key, text)


def only_kept(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``found`` has as kept, by key and text_sign; of rows repeated as
    a whole one."""
    found = found.select(F.col(key).alias("_k"), F.col("text_sign").alias("_s"), "kept")
    decided = scratch.materialise(found, "simhash-kept")
    # Rows that need a look: those to drop, and kept ones that are repeated as a whole.
    marked = scratch.materialise(
        decided.groupBy("_k", "_s").agg(F.bool_or("kept").alias("_repeated"), F.count("*").alias("_n"))
        .where(~F.col("_repeated") | (F.col("_n") > 1)).drop("_n"), "simhash-marked")
    names = [f"_{i}" for i in range(len(docs.columns))]
    k, t = (names[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*names).withColumn("_sign", F.xxhash64(t))
    # Most rows need none: the filter lets them by, and only the others are moved.
    built = bloom.build(marked.withColumn("_pair", F.struct("_k", "_s")), "_pair", marked.count())
    rows = bloom.flagged(rows, F.struct(F.col(k), F.col("_sign")), built, "_maybe")
    looked = rows.where("_maybe").join(
        marked, F.col(k).eqNullSafe(F.col("_k")) & (F.col("_sign") == F.col("_s")), "left")
    kept = rows.where("NOT _maybe").select(*names).unionByName(
        looked.where("_repeated IS NULL").select(*names)).unionByName(
        looked.where("_repeated").dropDuplicates([k, t]).select(*names))
    return kept.toDF(*docs.columns)
