import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardflow import scratch
from wardflow.llm import idstore
from wardflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
library = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    coder = idstore.Encoder(f.read(), 2)


def ids_of(text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def sign(text):
    raw = text.encode()
    return len(raw), np.uint64(xxhash.xxh64_intdigest(raw, 42)).astype(np.int64)


def expected(rows):
    """(key, start, number, crc32) by the documents in order."""
    at, out = 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *sign(r[1] or ""))):
        i = ids_of(t)
        n, raw = len(i), np.array(i, "<u4").tobytes()
        out.append((k, at, n, zlib.crc32(raw)))
        at += n
    return out


def written(spark, rows, kind="long", **options):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], f"doc_id {kind}, text string, file string, n int")
    root = scratch.new_path(spark, "store")
    idstore.write_store(df.repartition(3), root, PATH, **options)
    return df, root


def read(spark, df, root):
    found = idstore.read_keys(df.select("doc_id").distinct(), root)
    assert found.columns == ["doc_id", "start", "n_ids", "ids"]
    return sorted(((r.doc_id, r.start, r.n_ids, zlib.crc32(r.ids)) for r in found.collect()), key=lambda r: r[1])


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\x0b\x1c\x85'sΣİ̌́AÉßJ.,?")), max_size=40))
def test_chunks_are_encoded_like_whole_texts(text):
    assert np.frombuffer(coder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_special_strings_and_a_full_table(monkeypatch):
    monkeypatch.setattr(idstore, "CHUNKS", 3)
    for text in ("a <|endoftext|>b<|startoftext|> c", "one two three four one two", "x" * 5000, " ", ""):
        assert np.frombuffer(coder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_every_key_has_its_own_slot(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, 2 * n).astype(np.uint64) for _ in range(2))
    a[:n // 2] = a[0] if n else 0  # one hash alone does not tell keys apart
    hashed = idstore.PerfectHash.build(a[:n], b[:n])
    assert sorted(hashed.slots(a[:n], b[:n]).tolist()) == list(range(n))
    assert (hashed.slots(a[n:], b[n:]) < max(n, 1)).all()
    assert len(hashed.words) * 64 < 8 * n + 1000


def test_equal_hashes_are_an_error():
    same = np.array([1, 1], np.uint64)
    with pytest.raises(ValueError, match="same hashes"):
        idstore.PerfectHash.build(same, same)


def test_round_trip_with_repeats_nulls_and_small_shards(spark):
    rng = random.Random(2)
    rows = [(rng.randint(-50, 400), " ".join(rng.choices(["wait", "Ärzte", "room.", "x9"], k=rng.randint(0, 30))))
            for _ in range(500)]
    rows += [(7, "the same text")] * 300 + [(None, "no key"), (None, None), (9, None), (9, ""), (10, "long " * 20_000)]
    for shard_bytes in (1 << 30, 500):
        df, root = written(spark, rows, shard_bytes=shard_bytes)
        assert read(spark, df, root) == expected(rows)
    runs = idstore.locate(df.select("doc_id").distinct(), root).where("doc_id = 7").collect()
    assert len(runs) > 1 and sum(r.rows for r in runs) >= 300
    # Strangers are not found, also among known keys.
    asked = spark.createDataFrame([(k,) for k in [*range(1000, 3000), 7]], "doc_id long")
    assert idstore.locate(asked, root).select("doc_id").distinct().collect() == [(7,)]


def test_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(idstore, "KEYS_PER_BUCKET", 50)
    rows = [(i, f"text {i}") for i in range(600)]
    df, root = written(spark, rows)
    assert spark.read.parquet(f"{root}/buckets").agg({"keys": "sum"}).first()[0] == 600
    assert read(spark, df, root) == expected(rows)


def test_string_keys(spark):
    df, root = written(spark, [("b", "two words"), ("a", "One"), ("ü", "")], kind="string")
    assert [r[0] for r in read(spark, df, root)] == ["a", "b", "ü"]


def test_no_rows(spark):
    df, root = written(spark, [])
    assert read(spark, df, root) == []


def test_long_reads_are_cut(spark, monkeypatch):
    reader = idstore._Reader
    monkeypatch.setattr(idstore, "READ_BYTES", 64)
    rows = [(i, "word " * (i % 40)) for i in range(200)]
    df, root = written(spark, rows)
    name, base, width = spark.read.parquet(f"{root}/manifest").select("file", "base", "width").first()
    found = [r for part in reader(f"{root}/payload").read([(None, name, 0, 200, base, width)]) for r in part]
    assert [(s, n, zlib.crc32(i)) for _, s, n, i in found] == [e[1:] for e in expected(rows)]


def test_query_reads_every_document(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_idstore"](spark, FOLDER).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected([tuple(r) for r in docs])
