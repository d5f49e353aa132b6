"""Lexicons learnt from labelled texts: log odds of each term, with a prior.

A term's weight for a label is the log odds of the share of the label's texts that have the term,
less the log odds in all other texts. Counts get a prior, so a term seen once says little, and a
term is kept only where its weight is well beyond its own standard error. Everything is counted
in Spark over all labelled texts; weights are decimals, so that sums are the same in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.functions.text import WEIGHT_TYPE, words

PRIOR = 0.5   # texts of each sort that are added to every count
LEAST = 5.0   # standard errors that a weight must be away from zero


def _log_odds(having: Column, of: Column, prior: float) -> Column:
    return F.log((having + F.lit(prior)) / (of - having + F.lit(prior)))


def learn(docs: DataFrame, text: str, label: str, prior: float = PRIOR, least: float = LEAST) -> DataFrame:
    """position, label, term, weight (decimal), n (the label's texts with the term): a lexicon table
    for :func:`phrases.classify_by_lexicon`.

    Terms are single folded words. Only rows with a text and a label count, repeated rows each.
    Positions follow the labels' order as text. With one label only, or none, nothing is learnt.
    Positive weights and negative ones are kept; the latter speak against a label.
    """
    # By the text, not by its words: the rows per label are counted without splitting anything.
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.array_distinct(words(F.col(text))).alias("terms"))
    # One row per label: as many as there are labels.
    sizes = scratch.materialise(rows.groupBy("label").agg(F.count("*").alias("size")), "label-sizes")
    places = sizes.select("label", "size", F.expr("row_number() OVER (ORDER BY label) - 1").alias("position"),
                          F.expr("sum(size) OVER ()").alias("all"))
    counts = scratch.materialise(
        rows.select("label", F.explode_outer("terms").alias("term")).where("term IS NOT NULL")
        .groupBy("term", "label").agg(F.count("*").alias("n")), "term-counts")
    # A term's row for each label, also those whose texts do not have it.
    totals = counts.groupBy("term").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("by_label"))
    every = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.position).alias("position"),
                               F.lit(r["size"]).alias("size"), F.lit(r["all"]).alias("all"))
                      for r in places.where("size < all").orderBy("position").collect()])
    if places.count() < 2:
        return counts.limit(0).select(F.lit(0).alias("position"), "label", "term",
                                      F.lit(0).cast(WEIGHT_TYPE).alias("weight"), "n")
    each = totals.select("term", "total", "by_label", F.explode(every).alias("l")).select(
        "term", "total", "l.*", F.coalesce(F.try_element_at("by_label", F.col("l.label")), F.lit(0)).alias("n"))
    here, there = F.col("n"), F.col("total") - F.col("n")
    weight = _log_odds(here, F.col("size"), prior) - _log_odds(there, F.col("all") - F.col("size"), prior)
    error = F.sqrt(1 / (here + F.lit(prior)) + 1 / (there + F.lit(prior)))
    return each.where(F.abs(weight) >= F.lit(least) * error).select(
        "position", "label", "term", F.round(weight, 6).cast(WEIGHT_TYPE).alias("weight"), "n")
