"""The registered queries against their oracle SQL or what their results must satisfy."""

import hashlib
import itertools
import os
import re
import zlib

import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardflow.llm import langid, pii, simhash
from wardflow.llm.queries import ORACLES, PII_KEY, QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_oracle(spark, duck, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_simhash_against_all_pairs(spark, texts):
    ids = sorted(texts)
    prints = np.array([simhash.fingerprint(texts[d]) for d in ids], np.uint64)
    component = {d: d for d in ids}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    changed = True
    while changed:
        changed = False
        for i, d in enumerate(ids):
            least = min(component[ids[j]] for j in np.flatnonzero(near[i]))
            changed |= least < component[d]
            component[d] = min(component[d], least)
    found = QUERIES["op2_simhash"](spark, FOLDER).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (d, f"{int(p):016x}", component[d]) for d, p in zip(ids, prints, strict=True)}


def test_bpe_and_packing_against_the_library(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in texts.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {tuple(r) for r in QUERIES["op7_bpe"](spark, FOLDER).collect()}
    assert found == {(d, len(i), sha(",".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False)))
                     for d, i in ids.items()}
    pieces = QUERIES["op5_packing"](spark, FOLDER).collect()
    used, spans = {}, {}
    for p in pieces:
        own = [*ids[p.doc_id], 1]
        assert p.doc_tokens == len(own) and p.length > 0
        assert p.ids_crc32 == zlib.crc32(np.array(own[p.start:p.start + p.length], "<u4").tobytes())
        used.setdefault(p.doc_id, []).append((p.start, p.length))
        spans.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, i in ids.items():
        at = 0
        for start, length in sorted(used[d]):
            assert start == at
            at += length
        assert at == len(i) + 1
    padding = total = 0
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.01 * total


def test_language_and_quality_rows(spark, texts):
    found = QUERIES["op8_langid"](spark, FOLDER).collect()
    assert {r.doc_id for r in found} == set(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    assert {r.doc_id for r in QUERIES["op9_resampling"](spark, FOLDER).collect()} == set(texts)


def test_pseudonyms_only_where_something_is_found(spark, texts):
    for r in QUERIES["op3_feistel"](spark, FOLDER).collect():
        assert (r.text == texts[r.doc_id]) == (r.n_values == 0)
        for value in re.findall(r"(?<![0-9])[0-9]{16}(?![0-9])|\S+@\S+|token = \"\S+\"", texts[r.doc_id]):
            assert value not in r.text


def least_of_classes(texts):
    """The smallest id of every class of texts whose fingerprints differ in three bits at most."""
    prints = {d: simhash.fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {find(d) for d in prints}


def test_stages_keep_columns_with_the_operators_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(30)
    names = ["score", "lang_pred", "pii_kinds", "_0", "fingerprint", "_key", "component_id", "_hash"]
    odd = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, odd, FOLDER)
        assert found.schema.simpleString() == odd.schema.simpleString(), name
        rows = found.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name
    assert corpus_pipeline.packing(spark, odd, FOLDER).count() >= 30


def test_stages_on_nulls_repeats_and_long_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    more = [(900, None, None, None, None), (None, "", "en", "s", 0), (901, "long words here " * 30_000, "en", "s", 1)]
    odd = docs.unionByName(docs).unionByName(spark.createDataFrame(more * 2, docs.schema))
    given = {r.doc_id for r in odd.collect()}
    spoken = {r.doc_id for r in corpus_pipeline.language_id(spark, odd, FOLDER).collect()}
    assert 900 not in spoken and None not in spoken
    for stage in (corpus_pipeline.exact_copies, corpus_pipeline.near_copies):
        ids = [r.doc_id for r in stage(spark, odd, FOLDER).collect()]
        assert len(ids) == len(set(ids)) and 901 in ids and len({900, None} & set(ids)) == 1
    assert {r.doc_id for r in corpus_pipeline.personal_data(spark, odd, FOLDER).collect()} == given
    pieces = corpus_pipeline.packing(spark, odd, FOLDER).collect()
    assert {r.doc_id for r in pieces} == given and all(0 < r.length <= 2048 for r in pieces)


def test_pipeline_stage_by_stage(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["language_id", "exact_dedup", "near_dedup", "pii", "packing"]
    odd = spark.createDataFrame([(10 ** 6, "123 !!", "en", "s", 7), (10 ** 6 + 1, None, "en", None, None)], docs.schema)
    speaking = by_name["language_id"](spark, docs.unionByName(odd), FOLDER)
    assert speaking.columns == docs.columns
    ids = {r.doc_id for r in speaking.select("doc_id").collect()}
    assert ids <= set(texts) and len(ids) > 0.97 * len(texts)
    alone = by_name["exact_dedup"](spark, docs, FOLDER)
    assert alone.columns == docs.columns
    normal = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in alone.collect()]
    assert len(set(normal)) == len(normal) == len({re.sub(r"[\x20\x09-\x0D]", "", t) for t in texts.values()})
    far = by_name["near_dedup"](spark, docs, FOLDER)
    assert far.columns == docs.columns
    assert {r.doc_id for r in far.collect()} == least_of_classes(texts)
    clean = by_name["pii"](spark, docs, FOLDER)
    assert clean.columns == docs.columns
    expected = {r.doc_id: r.text for r in pii.pseudonymise(docs, PII_KEY).collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in clean.collect())


def test_pipeline_as_a_whole(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in kept.select("doc_id").collect()}
    sizes = {}
    for r in found:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert all(sizes[r.doc_id] == r.doc_tokens for r in found)


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_rejected_texts_have_no_letters_or_no_clear_language():
    assert langid.counts("..") is None and corpus_pipeline.LEAST_SCORE <= 0.5
