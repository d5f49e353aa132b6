"""The pipeline's language stage where nothing can be learnt."""

import corpus_pipeline
from pyspark.sql import functions as F

from wardflow.llm import langid

FOLDER = "/root/testdata/sf0.001"


def test_language_stage_without_labels_keeps_documents_with_letters(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    schema = docs.schema
    odd = spark.createDataFrame([(10 ** 6, "123 !!", None, "s", 7), (10 ** 6 + 1, None, None, None, None)], schema)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    only_held_out = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.col("lang")))
    for given in (unlabelled, only_held_out):
        kept = corpus_pipeline.language_id(spark, given.unionByName(odd), FOLDER)
        expected = {r.doc_id for r in given.collect() if langid.counts(r.text) is not None}
        assert expected and {r.doc_id for r in kept.collect()} == expected
