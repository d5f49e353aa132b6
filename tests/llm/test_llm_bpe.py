"""Encoding and decoding against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_spec(PATH))


ODD = ["", " ", "  a   b \n\n c\t\t d ", "<|endoftext|>x <|endoftext|> <|endoftext", "a" * 3000, "é" * 300 + " " * 77 + "x",
       "\0 a\x1c!\x1f b", "I'll don't 'S it's''s 'tis", "日本語 テスト　　x  y", "\U00010940\U00010941 x՘y",
       "\n \n", " \n x", "x \n", "x" * 32 + " " + "y" * 33, "😀 👩‍👩"]


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_odd_texts(library, codec):
    for text, packed in zip(ODD, codec.encode_many(ODD), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids(packed) == expected, text
        assert codec.decode(expected) == library.decode(expected, skip_special_tokens=False) == text


def test_random_texts_and_cuts(library, codec, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    random.seed(3)
    assert max(len(list(bpe._pieces(t))) for t in ODD) > 1
    letters = "ab '\n\t 　é1,²\0\x1c<|endoftext|>stlvre"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    for text, packed in zip(texts, codec.encode_many(texts), strict=True):
        assert ids(packed) == library.encode(text, add_special_tokens=False).ids, text


def test_heap_and_rank_array_agree(codec):
    random.seed(5)
    for _ in range(300):
        word = bytes(random.choice(b"aeinrst\xc3\xa9") for _ in range(random.randint(1, 32)))
        size = np.array([len(word)])
        _, merged = codec._merge_short(bpe._packed(word, np.array([0]), size), size)
        assert merged.tolist() == ids(codec._merge_long(word))


def test_words_are_forgotten_when_the_table_is_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLOT_BITS", 6)
    small = bpe.Codec(bpe.read_spec(PATH))
    for n in range(40):
        text = f"alpha{n} beta{n * 7} gamma"
        assert ids(small.encode_many([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_more_new_words_than_the_table_holds(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLOT_BITS", 6)
    small = bpe.Codec(bpe.read_spec(PATH))
    text = " ".join(f"w{n}x" for n in range(500))
    assert ids(small.encode_many([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_frames(spark, library):
    rows = [(1, "Hello world", "a"), (2, None, "b"), (2, "", "c"), (None, "x <|endoftext|>", None), (1, "Hello world", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    found = sorted(((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in out.collect()), key=str)
    assert found == sorted(((d, t, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "")
                            for d, t, _ in rows), key=str)
    both = bpe.encode_decode(df, PATH, keep=["doc_id", "text"]).select(*out.columns)
    assert sorted(((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in both.collect()), key=str) == found
    assert bpe.encode(df.limit(0), PATH).count() == 0 == bpe.encode_decode(df.limit(0), PATH).count()


def test_null_and_unknown_ids(spark, codec):
    df = spark.createDataFrame([(1, None), (2, []), (3, [464, 99999999])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(df, PATH).collect()} == {1: None, 2: "", 3: codec.decode([464])}
