"""Labels kept between runs: a store addressed by what was labelled and by which rule.

A text's key is its SHA-256, a rule's the SHA-256 of its definition, so a text that comes again,
under any id, in any table or run, is not labelled again, and a changed rule starts anew. A run
labels the texts that the store does not know and adds them as a batch, which counts once its
``_SUCCESS`` is there. Labels carry no text: they are narrow, and facts are joined to them by
digest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch

SIGN = "_sign"
#: Part of every fingerprint: to be raised when the text functions change what they return.
VERSION = 1


def fingerprint(definition: object) -> str:
    """A rule's key, from a definition of plain values (lexicons, defaults, patterns). The order of
    a mapping counts, because it breaks ties between labels."""
    text = json.dumps([VERSION, definition], ensure_ascii=False, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


def batches(spark: SparkSession, root: str, definition: object) -> list[str]:
    """Folders of the complete batches of a rule."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/regra={fingerprint(definition)}/*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(s.getPath().getParent().toString() for s in found)


def known(spark: SparkSession, root: str, definition: object, schema: T.StructType) -> DataFrame:
    """The stored labels, one row per text; ``schema`` is that of the batches. Two runs at once may
    have stored a text twice, with equal labels."""
    paths = batches(spark, root, definition)
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.dropDuplicates([SIGN]) if len(paths) > 1 else rows


def labelled(docs: DataFrame, text: str, root: str, definition: object,
             add: Callable[[DataFrame], DataFrame], keep_text: bool = True) -> DataFrame:
    """The rows of ``docs`` with the columns that ``add`` adds, computed for new texts only.

    ``add`` gets a frame of distinct texts (the column ``text`` and a digest) and returns it with
    further columns that depend on the text and the definition alone; it may call native
    expressions or Python. NULL text has NULL labels; rows may be repeated, names must not clash
    with the added columns. No rows add no batch.

    Digests are compared first; texts move only if they are new, once, to be made distinct. A store
    without a batch knows no text, so nothing is compared. Without ``keep_text`` the rows come back
    without their text, and those of a store with batches from the first pass over the texts.
    """
    spark = docs.sparkSession
    sign = F.unhex(F.sha2(F.col(text), 256))
    signed = docs.withColumn(SIGN, sign)
    empty = add(spark.createDataFrame([], T.StructType([
        T.StructField(SIGN, T.BinaryType()), docs.schema[text]])))
    names = [c for c in empty.columns if c not in (SIGN, text)]
    schema = T.StructType([T.StructField(SIGN, T.BinaryType()),
                           *(T.StructField(c, empty.schema[c].dataType) for c in names)])
    kept = docs.columns if keep_text else [c for c in docs.columns if c != text]
    rows, new = signed.select(SIGN, *kept), signed.select(SIGN, text).where(F.col(text).isNotNull())
    if batches(spark, root, definition):
        before = known(spark, root, definition, schema)
        if not keep_text:
            rows = scratch.materialise(rows, "signed")
        # Written, so that its size decides how the texts meet it.
        unseen = scratch.materialise(
            rows.select(SIGN).where(F.col(SIGN).isNotNull()).distinct().join(before.select(SIGN), SIGN, "left_anti"),
            "unseen")
        new = None if unseen.isEmpty() else new.join(unseen, SIGN)
    elif new.isEmpty():
        new = None
    if new is not None:
        add(new.groupBy(SIGN).agg(F.first(text).alias(text))).select(SIGN, *names).write.parquet(
            f"{root}/regra={fingerprint(definition)}/lote={uuid.uuid4().hex}")
    stored = known(spark, root, definition, schema).withColumnRenamed(SIGN, "_stored")
    return rows.join(stored, F.col(SIGN) == F.col("_stored"), "left").select(*kept, *names)


def labelled_by_rules(docs: DataFrame, text: str, root: str, lexicons: dict[str, tuple[dict, str]],
                      keep_text: bool = True) -> DataFrame:
    """The rows with a label per lexicon: name -> (lexicon, default label)."""
    from wardflow.functions import text as X

    def add(texts: DataFrame) -> DataFrame:
        rules = {name: X.class_rule(lexicon, default) for name, (lexicon, default) in lexicons.items()}
        labels = X.label_all(F.col(text), rules)
        return texts.withColumn("_labels", labels).select(*texts.columns, "_labels.*")

    definition = [[name, [[label, list(terms.items())] for label, terms in lexicon.items()], default]
                  for name, (lexicon, default) in lexicons.items()]
    return labelled(docs, text, root, definition, add, keep_text)
