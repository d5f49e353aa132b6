"""Batch enrichment by a Python callable, called once per distinct input."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch


def _digest(names: Sequence[str]) -> Column:
    """A key of fixed size for the inputs: SHA-256 of their JSON form, in which a NULL is an
    absent field."""
    return F.unhex(F.sha2(F.to_json(F.struct(*names)).cast("binary"), 256))


def enrich_distinct(df: DataFrame, inputs: Sequence[str],
                    fn: Callable[[pd.DataFrame], pd.DataFrame],
                    outputs: T.StructType) -> DataFrame:
    """Add the columns ``outputs``, computed by ``fn`` from the columns ``inputs``.

    ``fn`` gets a pandas frame of distinct inputs, one batch at a time, and returns a frame of
    the output columns with the same rows. The results are written as a table before they
    are joined back, so a filter on an output column does not call ``fn`` again, and a lost
    executor does not repeat finished calls.

    Inputs meet their answers by digest: the stored answers carry no text, so they are small
    and often broadcast. Copies of an input are one row per task before they are shuffled, and
    a hot digest on the way back is split by adaptive execution, in as many parts as its rows need.
    """
    names = list(inputs)
    distinct = df.groupBy(_digest(names).alias("__key")).agg(*[F.first(c).alias(c) for c in names])
    schema = T.StructType([T.StructField("__key", T.BinaryType()), *outputs.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = fn(batch[names].reset_index(drop=True))
            yield pd.concat([batch[["__key"]].reset_index(drop=True),
                             answers[outputs.names].reset_index(drop=True)], axis=1)

    answers = scratch.materialise(distinct.mapInPandas(run, schema), "enriched")
    return df.withColumn("__key", _digest(names)).join(answers, "__key").select(*df.columns, *outputs.names)
