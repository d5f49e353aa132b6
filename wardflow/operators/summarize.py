"""Extractive summaries under a word budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.text import words

SENTENCE_END = r"[.!?\n]+"


def summarize(docs: DataFrame, key: str, text: str, max_words: int,
              summary: str = "resumo") -> DataFrame:
    """(key, summary, n_palavras) for every row: its most typical sentences, in text order.

    A sentence scores the mean in-text frequency of its words. Sentences are taken by score
    (ties by position) as long as their words fit the budget together with all better
    ones; text without a fitting sentence gives an empty summary, NULL gives NULL.

    The texts are shuffled once, by key. All later steps group by that key and something
    else, which this partitioning already satisfies, so the exploded words never move. A word's
    row has the word and its sentence's place only; the chosen places fetch their sentences
    from the text at the end.
    """
    placed = docs.select(key, text).repartition(key)
    # Outer explodes: a plain one adds a filter that computes its array a second time.
    sentences = placed.select(
        key, F.posexplode_outer(F.split(F.col(text), SENTENCE_END)).alias("pos", "raw"))
    in_text = Window.partitionBy(key, "token")
    frequencies = (
        sentences.select(key, "pos", F.explode_outer(words(F.col("raw"))).alias("token"))
        .where(F.col("token").isNotNull())
        .withColumn("tf", F.count("*").over(in_text))
    )
    scored = frequencies.groupBy(key, "pos").agg(
        F.sum("tf").alias("tf_sum"), F.count("*").alias("n_words"))
    by_score = (
        Window.partitionBy(key)
        .orderBy((F.col("tf_sum") / F.col("n_words")).desc(), F.col("pos"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = scored.withColumn("so_far", F.sum("n_words").over(by_score)).where(
        F.col("so_far") <= max_words)
    lines = picked.groupBy(F.col(key).alias("__doc")).agg(
        F.sort_array(F.collect_list("pos")).alias("kept"), F.sum("n_words").alias("kept_words"))
    split = F.transform(F.array(F.split(F.col(text), SENTENCE_END)), lambda parts: F.array_join(
        F.transform("kept", lambda at: F.trim(F.regexp_replace(parts[at], r"[ \t\r]+", " "))), ". "))[0]
    return (
        placed.join(lines, F.col(key) == F.col("__doc"), "left")
        .select(
            key,
            F.when(F.col(text).isNotNull(), F.coalesce(split, F.lit(""))).alias(summary),
            F.when(F.col(text).isNotNull(), F.coalesce(F.col("kept_words"), F.lit(0).cast("long")))
            .alias("n_palavras"),
        )
    )
