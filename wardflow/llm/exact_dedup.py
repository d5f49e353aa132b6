"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Whole texts without white space are compared. A first scan reduces every text to its length
and a hash of its beginning, and only groups of two rows at least go on. A second scan passes
the survivors' keys as a blocked Bloom filter, so only texts of surviving groups (and the few
strangers that an exact join then stops) are moved and get a full hash. DataFrame code only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.llm import bloom

PREFIX_CHARS = 256  # of the normalised text, for the prefix hash; the full hash decides


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", "")


def full_hash(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def _prefix_hash(norm: Column) -> Column:
    return F.xxhash64(F.substring(norm, 1, PREFIX_CHARS))


def _sign(length: Column, prefix: Column) -> Column:
    return F.struct(length.alias("_length"), prefix.alias("_prefix"))


def _sized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, original length, normalised text, and the two cheap signs of it."""
    rows = docs.select(docs[key].alias("_key"), F.coalesce(F.length(docs[text]), F.lit(0)).alias("_chars"),
                       normalised(docs[text]).alias("_norm"))
    return rows.withColumns({
        "_length": F.length("_norm"),
        "_prefix": _prefix_hash(F.col("_norm"))})


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each text that two rows or more have.

    Columns: _hash (binary), _length and _prefix (its cheap signs), _keep_key, _keep_chars (the row that stays: most code points of the
    original text, then the smallest key, null keys last), _size, _repeats (rows with the key
    and length of the one that stays).
    """
    # One aggregation does both cheap levels: rows of one length, and in it of one prefix. A
    # length of one row has one prefix of one row, so it ends here too.
    sized = _sized(docs, key, text)
    survivors = scratch.materialise(
        sized.groupBy("_length", "_prefix").agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1).select("_length", "_prefix"), "dedup-survivors")
    sign = _sign(F.col("_length"), F.col("_prefix"))
    filter_ = bloom.build(survivors.withColumn("_sign", sign), "_sign", survivors.count())
    read_again = bloom.possible(sized, sign, filter_).join(survivors, ["_length", "_prefix"])
    full = read_again.select("_key", "_chars", "_length", "_prefix", full_hash(F.col("_norm")).alias("_hash"))
    best = F.struct((-F.col("_chars")).alias("c"), F.col("_key").isNull().alias("n"), F.col("_key").alias("k"))
    # Equal rows first, so that a hot text is one partial row of each task.
    once = full.groupBy("_hash", "_length", "_prefix", "_key", "_chars").agg(F.count("*").alias("_n"))
    groups = once.groupBy("_hash", "_length", "_prefix").agg(
        F.sum("_n").alias("_size"),
        F.min(F.struct(best.alias("b"), F.col("_n").alias("n"))).alias("_best"))
    return groups.where(F.col("_size") > 1).select(
        "_hash", "_length", "_prefix", F.col("_best.b.k").alias("_keep_key"), (-F.col("_best.b.c")).alias("_keep_chars"),
        "_size", F.col("_best.n").alias("_repeats"))


def _stays(key: Column, chars: Column) -> Column:
    return F.col("_hash_of_group").isNull() | (
        key.eqNullSafe(F.col("_keep_key")) & (chars == F.col("_keep_chars")))


def _with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    groups = groups.withColumnRenamed("_hash", "_hash_of_group").drop("_length", "_prefix")
    return rows.join(groups, F.col("_hash") == F.col("_hash_of_group"), "left")


def _only_one(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Column _first: false for all but one of the rows that share the kept row's key and
    length. Such repeated rows are rare; without any there is nothing to mark. They are written
    with a row id, so no task ever holds all rows of a group."""
    if groups.where(F.col("_repeats") > 1).isEmpty():
        return rows.withColumn("_first", F.lit(True))
    repeated = F.coalesce(F.col("_repeats") > 1, F.lit(False)) & F.col("_stays")
    written = scratch.materialise(
        rows.where(repeated).withColumn("_row", F.monotonically_increasing_id()), "dedup-repeated")
    least = written.groupBy("_hash").agg(F.min("_row").alias("_least")).select("_least")
    marked = written.join(least, F.col("_row") == F.col("_least"), "left").withColumn(
        "_first", F.col("_least").isNotNull()).drop("_row", "_least")
    return rows.where(~repeated).withColumn("_first", F.lit(True)).unionByName(marked)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_hash (binary).

    Texts are equal when they are the same after deleting white space; null is empty, and all
    empty texts are one group. Of rows that repeat the kept row (key, length and normalised
    text), exactly one stays. Null keys are kept only if no row of the group has a key. Other
    columns play no part.
    """
    groups = scratch.materialise(duplicate_groups(docs, key, text), "dedup-groups")
    rows = _sized(docs, key, text).select("_key", "_chars", full_hash(F.col("_norm")).alias("_hash"))
    found = _with_groups(rows, groups).withColumn("_stays", _stays(F.col("_key"), F.col("_chars")))
    found = _only_one(found, groups)
    alone = F.col("_hash_of_group").isNull()
    return found.select(
        F.col("_key").alias(key),
        F.when(alone, F.col("_key")).otherwise(F.col("_keep_key")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        (F.col("_stays") & F.col("_first")).alias("kept"),
        F.col("_hash").alias("text_hash"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = scratch.materialise(duplicate_groups(docs, key, text), "dedup-groups")
    names = [f"_{i}" for i in range(len(docs.columns))]
    k, t = (F.col(names[docs.columns.index(c)]) for c in (key, text))
    norm = normalised(t)
    rows = docs.toDF(*names).withColumns({
        "_sign": _sign(F.length(norm), _prefix_hash(norm)), "_chars": F.coalesce(F.length(t), F.lit(0))})
    # Most rows are in no group: the filter of the cheap signs lets them by, and only the others
    # are hashed in full and moved.
    signs = groups.select(_sign(F.col("_length"), F.col("_prefix")).alias("_sign"))
    rows = bloom.flagged(rows, F.col("_sign"), bloom.build(signs, "_sign", groups.count()), "_maybe")
    hashed = rows.where("_maybe").withColumn("_hash", full_hash(norm))
    found = _with_groups(hashed, groups).withColumn("_stays", _stays(k, F.col("_chars"))).where("_stays")
    repeated = F.coalesce(F.col("_repeats") > 1, F.lit(False))
    once = found.where(repeated).dropDuplicates(["_hash", names[docs.columns.index(key)], "_chars"])
    return rows.where("NOT _maybe").select(*names).unionByName(
        found.where(~repeated).select(*names)).unionByName(once.select(*names)).toDF(*docs.columns)
