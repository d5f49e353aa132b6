"""Packing: every id once, no limit exceeded, little padding."""

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardflow.llm.packing import Example, Limits, _pack, pack_texts, pack_window
from wardflow.llm.queries import TURN_LIMITS, packing_turns

FOLDER = "/root/testdata/sf0.001"

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(examples, limits, sequences, rest=()):
    parts = defaultdict(list)
    for s in sequences:
        assert sum(e.length for e in s) <= limits.tokens
        assert len(s) <= limits.segments
        assert sum(e.loss for e in s) <= limits.loss
        for e in s:
            parts[e.row].append((e.start, e.length, e.loss))
    for e in rest:
        parts[e.row].append((e.start, e.length, e.loss))
    for e in examples:
        at = loss = 0
        for start, length, bearing in sorted(parts[e.row]):
            assert start == at and length > 0 and 0 <= bearing <= length
            at, loss = at + length, loss + bearing
        assert (at, loss) == (e.length, e.loss)


@pytest.mark.parametrize("limits", [Limits(100, 100, 100), Limits(100, 3, 100), Limits(100, 50, 30), Limits(1, 1, 1),
                                    Limits(64, 2, 1)])
def test_windows_keep_every_token_within_all_limits(limits):
    random.seed(11)
    for _ in range(30):
        sizes = [random.choice([1, 2, 5, 30, 99, 100, 101, 350]) for _ in range(random.randint(0, 25))]
        examples = [Example(i, 0, n, random.choice([0, n // 2, n])) for i, n in enumerate(sizes)]
        for last in (False, True):
            sequences, rest = pack_window(examples, limits, last)
            check(examples, limits, sequences, rest)
            assert not (last and rest)
            assert last or sum(e.length for e in rest) < limits.tokens


def test_sequences_are_full_but_for_the_rest():
    examples = [Example(i, 0, 30 + i, 30 + i) for i in range(40)]
    sequences, _ = pack_window(examples, Limits(256, 256, 256), True)
    sizes = [sum(e.length for e in s) for s in sequences]
    assert all(n == 256 or n & (n - 1) == 0 for n in sizes)
    assert sizes.count(256) == sum(e.length for e in examples) // 256


def test_the_dot_product_prefers_what_fills_the_room():
    # Room left after the long example: many loss-bearing tokens but few tokens.
    examples = [Example(0, 0, 90, 0), Example(1, 0, 10, 10), Example(2, 0, 10, 0), Example(3, 0, 90, 90)]
    sequences, rest = pack_window(examples, Limits(100, 10, 100), True)
    assert rest == [] and sorted(sorted(e.row for e in s) for s in sequences if sum(e.length for e in s) == 100)


def test_limits_must_be_positive():
    with pytest.raises(ValueError):
        Limits(0, 1, 1)


def test_texts(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(i, "some words and more " * (i * 7 % 190), i) for i in range(60)]
    rows += [(7, "repeated id", 0), (None, "no id", 1), (61, None, 2), (62, "", 3), (63, "x y " * 30000, 4), (61, None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    found = pack_texts(df.coalesce(1), PATH, limits=Limits(256, 200, 256)).collect()
    expected = defaultdict(list)
    for d, t, _ in rows:
        expected[d].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.length * 4 == len(r.ids)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    for d, texts in expected.items():
        assert sum(r.length for r in by_doc[d]) == sum(map(len, texts))
        if len(texts) == 1:
            ids = b"".join(r.ids for r in sorted(by_doc[d], key=lambda r: r.start))
            assert ids == np.array(texts[0], "<u4").tobytes()
            assert {r.doc_tokens for r in by_doc[d]} == {len(texts[0])}
            assert zlib.crc32(ids) == zlib.crc32(np.array(texts[0], "<u4").tobytes())


def test_loss_column_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 3), (2, "g h", None), (3, "i", 99)], "doc_id long, text string, q int")
    assert {r.doc_id for r in pack_texts(df, PATH, loss_from="q", limits=Limits(64, 8, 4)).collect()} == {1, 2, 3}
    assert pack_texts(df.limit(0), PATH).count() == 0
    assert pack_texts(df.selectExpr("doc_id", "'' AS text"), PATH, end_id=None).count() == 0


@pytest.mark.parametrize("size", [1, 10])
def test_many_short_examples_take_time_in_proportion(size):
    begin = time.perf_counter()
    ids, pieces = b"\1\0\0\0" * size, 0
    for part in _pack(((i, ids, size) for i in range(200_000)), Limits(), 3):
        pieces += sum(len(p[2]) // 4 for p in part)
    assert pieces == 200_000 * size
    assert time.perf_counter() - begin < 20


def one_by_one(examples, limits):
    """The demands of the first sequence, each pick by a search among all examples."""
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    demand = np.array([(e.length, 1, e.loss) for e in examples], float)
    weight, room, free, out = demand.mean(0) / cap ** 2, cap.copy(), np.ones(len(examples), bool), []
    while (fits := free & (demand <= room).all(1)).any():
        i = int(np.argmax(np.where(fits, demand @ (weight * room), -1)))
        out.append((examples[i].length, examples[i].loss))
        room -= demand[i]
        free[i] = False
    return out


def test_picks_of_equal_demands_are_those_of_single_examples():
    random.seed(5)
    limits = Limits(4096, 300, 1500)
    for _ in range(20):
        kinds = [(n, random.randint(0, n)) for n in random.sample(range(20, 400), 7)]
        examples = [Example(i, 0, *random.choice(kinds)) for i in range(900)]
        sequences, _ = pack_window(examples, limits, False)
        expected = one_by_one(examples, limits)
        assert [(e.length, e.loss) for e in sequences[0]][:len(expected)] == expected


def test_turns_within_all_three_limits(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    found = packing_turns(spark, FOLDER).collect()
    library = Tokenizer.from_file(PATH)
    expected, by_turn, by_sequence = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
        expected[r.conv_id, r.turn].append((n, n if r.role == "assistant" else 0))
    for r in found:
        by_turn[r.conv_id, r.turn].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_turn.keys() == expected.keys()
    for key, sizes in expected.items():
        assert sum(r.length for r in by_turn[key]) == sum(n for n, _ in sizes)
        assert sum(r.loss for r in by_turn[key]) == sum(n for _, n in sizes)
    tight = set()
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
        used = (sum(r.length for r in parts), len(parts), sum(r.loss for r in parts))
        limits = (TURN_LIMITS.tokens, TURN_LIMITS.segments, TURN_LIMITS.loss)
        assert all(u <= m for u, m in zip(used, limits, strict=True))
        tight |= {i for i, (u, m) in enumerate(zip(used, limits, strict=True)) if u == m}
    assert {1, 2} <= tight
