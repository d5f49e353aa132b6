"""From raw documents to packed training sequences, in five stages.

Each stage's result is written as Parquet to the shared folder and read again as the next
one's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.llm import exact_dedup, langid, pii, simhash
from wardflow.llm.queries import PII_KEY, packed
from wardflow.session import apply_settings

ANY = "any"        # the one label of a model that has learnt nothing
LEAST_SCORE = 0.5  # of the language ID; a less certain document is rejected
NEAR_WORDS, NEAR_BITS = 3, 3  # near copies: fingerprints of word shingles, and bits that may differ


def _placed(docs: DataFrame) -> DataFrame:
    """Columns named by their places, so that none can clash with an operator's own."""
    return docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a clear language go; if no document could be learnt
    from, all with letters stay.

    Null and empty texts have no letters. Repeated rows are judged alike, very long texts whole;
    no documents give none. Other columns may have any names and stay as they are.
    """
    model = langid.fit(docs)
    if not model.weights.any():
        model = langid.Model([ANY], np.ones(langid.BUCKETS), np.zeros((1, langid.BUCKETS + 1)), 1.0)
    placed = _placed(docs)
    found = langid.predict(placed, model, text=placed.columns[docs.columns.index("text")])
    sure = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return sure.select(*placed.columns).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays.

    Null counts as empty, and all empty texts are one group. Of a group the longest original stays,
    then the smallest doc_id; of rows repeated as a whole one. No documents give none.
    """
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Texts without words, null ones too, have fingerprint zero and are linked like any other. Of
    rows repeated as a whole one stays; of rows with that doc_id the one with the smallest hash of
    its text. No documents give none.
    """
    return simhash.drop_near_copies(docs, words=NEAR_WORDS, radius=NEAR_BITS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; n_chars follows the text.

    Null texts stay null, with n_chars null; rows are neither dropped nor added, repeated ones get
    the same pseudonyms. Other columns may have any names and stay as they are.
    """
    placed = _placed(docs)
    text, chars = (placed.columns[docs.columns.index(c)] for c in ("text", "n_chars"))
    clean = pii.pseudonymise(placed, PII_KEY, text=text)
    return clean.withColumn(chars, F.length(text).cast("long")).select(*placed.columns).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    Null and empty texts consist of the end id. Repeated rows are packed each, very long texts cut
    into pieces; no documents give no pieces. Other columns play no part.
    """
    return packed(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packing),
]

#: No SQL expresses the stages; tests compare them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
