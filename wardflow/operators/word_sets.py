"""The word set of a text as sorted 64-bit hashes, made once per text from its bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.text import TEXT_ACCENTS, TEXT_PLAIN

#: Bytes of text that are hashed at a time (a longer text alone is more); arrays of some ten times that are held.
CHUNK_BYTES = 2 << 20

# What a byte is in a folded text: itself, its small letter, or 0 between words. The accents that are
# folded are two bytes in UTF-8, the first the same for all.
_LEAD = 0xC3
_PLAIN, _SECOND = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
for _c in "abcdefghijklmnopqrstuvwxyz0123456789":
    _PLAIN[ord(_c)] = _PLAIN[ord(_c.upper())] = ord(_c)
for _c, _p in zip(TEXT_ACCENTS, TEXT_PLAIN, strict=True):
    _first, _second = _c.encode()
    assert _first == _LEAD
    _SECOND[_second] = ord(_p.lower())
# The other letters with a letter a to z in their small form.
_ODD = {c: c.lower() for c in "İK"}
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Another 64-bit number for each, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts in text order, and where those of each text begin (one more: the
    end). ``data`` has the texts' bytes, text i from ``bounds[i]`` to ``bounds[i + 1]``. Words of up to
    eight letters have different hashes."""
    plain = _PLAIN[data]
    lead = np.flatnonzero(data[:-1] == _LEAD)
    letters = _SECOND[data[lead + 1]]
    lead, letters = lead[letters > 0], letters[letters > 0]
    plain[lead + 1] = letters
    bounds = bounds - np.searchsorted(lead, bounds)
    padded = np.zeros(len(plain) - len(lead) + 8, np.uint8)
    padded[:-8] = np.delete(plain, lead)
    inside = padded[:-7] > 0  # with one place behind the last byte
    cut = np.ones(len(inside) + 1, bool)  # no word goes on from the byte before
    cut[1:-1] = ~inside[:-1]
    cut[bounds] = True
    begins = np.flatnonzero(inside & cut[:-1])
    cut[:-1] |= ~inside
    ends = np.flatnonzero(inside[:-1] & cut[1:-1]) + 1
    lengths = ends - begins
    # Eight bytes from each place on, as one number.
    eight = np.ndarray(len(inside), "<u8", buffer=padded, strides=(1,))
    hashes = _mix(eight[begins] & _MASKS[np.minimum(lengths, 8)])
    longer, at = np.flatnonzero(lengths > 8), 8
    while len(longer):
        part = eight[begins[longer] + at] & _MASKS[np.minimum(lengths[longer] - at, 8)]
        hashes[longer] = _mix(hashes[longer] * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(at))
        at += 8
        longer = longer[lengths[longer] > at]
    return hashes, np.searchsorted(begins, bounds)


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, words and places of their begin (one more: the end), chunk by chunk."""
    texts = texts.cast(pa.string()).fill_null("")
    if (data := texts.buffers()[2]) is not None:
        data = data.to_pybytes()
        for odd in [c for c in _ODD if c.encode() in data]:
            texts = pc.replace_substring(texts, odd, _ODD[odd])
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        bounds = offsets[first:last + 1]
        hashes, places = _word_hashes(data[bounds[0]:bounds[-1]], bounds - bounds[0])
        for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
            hashes[a:b].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        new[places[:-1][places[:-1] < len(hashes)]] = True
        yield first, hashes[new], np.concatenate([[0], new.cumsum()])[places]
        first = last


def binary(numbers: np.ndarray, places: np.ndarray) -> pa.Array:
    """An array of binary values, value i with the bytes of ``numbers[places[i]:places[i + 1]]``."""
    offsets = (places * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(numbers)])


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and places of an array made by :func:`binary`."""
    values = values.cast(pa.binary())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]].view(np.uint64), (offsets - offsets[0]) // 8


def word_sets(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """(__key, __sign, __size, __words) of every text with words: a digest of the word set, the number
    of different words (those of :func:`wardflow.functions.text.words`), and their sorted hashes,
    eight bytes each. Texts do not move."""
    rows = df.select(key.alias("__key"), text.alias("__text"))
    schema = T.StructType([rows.schema["__key"], T.StructField("__sign", T.BinaryType()),
                           T.StructField("__size", T.IntegerType()), T.StructField("__words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, places in _sets(batch.column("__text")):
                held = np.flatnonzero(places[1:] > places[:-1])
                if len(held):
                    bounds = np.append(places[held], places[-1])
                    signs = [hashlib.blake2b(words[a:b], digest_size=16).digest()
                             for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("__key").take(pa.array(first + held)), pa.array(signs, pa.binary()),
                        pa.array(np.diff(bounds), pa.int32()), binary(words, bounds)], names=schema.names)

    return rows.where(F.col("__text").isNotNull()).mapInArrow(run, schema)
