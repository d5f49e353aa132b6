"""Byte-level BPE encoding and decoding of whole texts.

A word (what the split pattern yields) is merged by a contiguous rank array: part ids and the
ranks of adjacent pairs lie side by side, the smallest rank is looked for, its boundary is
deleted, and the two neighbouring ranks are looked up again. All new short words of a slice
of texts are merged together, one row of a matrix each; a longer word, where scanning for the
minimum would be quadratic, takes its pairs from a heap instead. Both give the same parts.

Texts are split by array operations over their code points. Words repeat, so the ids of short
words are kept in a hash table of bounded size per Python worker, keyed by their bytes.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: the split pattern of the byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LANES = 4                 # of 8 bytes: longer words go through the heap
SLOT_BITS = 19            # of the table of known words, which is emptied when half full
SLICE_CHARS = 250_000     # characters that are split into words at a time

_NONE = np.int64(1 << 40)
_word_end = re.compile(r"\S(?=[ \n])")
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = 1, 2, 3, 4, 5


@lru_cache(maxsize=None)
def char_classes(bits: int = 21) -> np.ndarray:
    """Class of every code point under ``2 ** bits`` for the split pattern. Code points that
    Python's tables do not know are unsure: texts with them are left to the library's own
    splitter, whose tables decide whether they are letters."""
    kind = {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}
    end = min(1 << bits, 0x110000)
    out = np.fromiter((kind.get(c[0], _UNSURE if c == "Cn" else _OTHER)
                       for c in map(unicodedata.category, map(chr, range(end)))), np.uint8, end)
    out[[*range(0x09, 0x0E), 0x85]] = _SPACE
    return out


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: visible bytes of Latin-1
    stand for themselves, the others for the letters from U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class _PairTable:
    """Hash table in arrays: (left id, right id) -> rank of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        self.bits = max(10, int(len(left)).bit_length() + 3)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int64)
        key, rank = left << 32 | right, np.arange(len(left), dtype=np.int64)
        slot, self.probes = self._slot(key), 0
        while len(key):
            free = self.keys[slot] < 0
            _, first = np.unique(slot, return_index=True)
            winner = np.zeros(len(key), bool)
            winner[first] = True
            winner &= free
            self.keys[slot[winner]], self.ranks[slot[winner]] = key[winner], rank[winner]
            key, rank = key[~winner], rank[~winner]
            slot = (slot[~winner] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; ``_NONE`` where the pair is never merged or an id is negative."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        key = left << 32 | right
        slot = self._slot(key)
        found = np.where(self.keys[slot] == key, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[open_]]
            hit = at == key[open_]
            found[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        found[(left < 0) | (right < 0)] = _NONE
        return found.reshape(shape)


class Codec:
    """Encoder and decoder of one vocabulary file (the JSON text of a byte-level BPE).

    Texts become packed ids: unsigned 32-bit integers, little-endian, as bytes.
    """

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        vocab: dict[str, int] = data["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64)
        ids = ids.reshape(-1, 3)
        self.merged = ids[:, 2]
        self.table = _PairTable(ids[:, 0], ids[:, 1])
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self._spec, self._pairs = spec, ids[:, 0] << 32 | ids[:, 1]
        self.known = _WordTable()

    @cached_property
    def rank_of(self) -> dict[int, int]:
        """Rank of every pair of ids; made when the first long word comes."""
        return {pair: rank for rank, pair in enumerate(self._pairs.tolist())}

    @cached_property
    def token(self) -> dict[int, bytes]:
        """Bytes of every id; made when something is decoded."""
        of_letter = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = json.loads(self._spec)["model"]["vocab"]
        plain = {i: b"".join(map(of_letter.__getitem__, t)) for t, i in vocab.items()}
        return plain | {i: t.encode() for t, i in self.special.items()}

    def forget(self) -> None:
        """Drop the words known so far and free memory that Arrow keeps: a worker that waits for
        other work should hold neither."""
        self.known = _WordTable()
        pa.default_memory_pool().release_unused()

    # ---- encoding ----

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text, whole."""
        pieces = [list(_pieces(t)) for t in texts]
        flat = iter(self._encode_pieces([p for ps in pieces for p in ps]))
        return [b"".join([next(flat) for _ in ps]) for ps in pieces]

    def _encode_pieces(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for part in _slices(texts):
            plain = [t if self._special is None or not self._special.search(t) else "" for t in part]
            packed = self._encode_slice(plain)
            out += [p if u == t else self._with_special(t)
                    for t, u, p in zip(part, plain, packed, strict=True)]
        return out

    def _with_special(self, text: str) -> bytes:
        pieces, at = [], 0
        for m in self._special.finditer(text):
            pieces += [*self._encode_slice([text[at:m.start()]]),
                       np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join(pieces + self._encode_slice([text[at:]]))

    def _encode_slice(self, texts: list[str]) -> list[bytes]:
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        sizes = np.array([len(t) for t in texts])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = char_classes(max(10, int(points.max()).bit_length()))[points]
        if (classes == _UNSURE).any():
            return [self._encode_odd(t) for t in texts]
        begins = np.cumsum(sizes) - sizes
        starts = _word_starts(points, classes, begins[sizes > 0])
        raw = joined.encode()
        if len(raw) == len(joined):
            at = starts
        else:
            width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            at = (np.cumsum(width) - width)[starts]
        counts, ids = self._words_at(raw, at, np.diff(at, append=len(raw)))
        # Ids before each word, then before each text's first word.
        before = np.concatenate([[0], np.cumsum(counts)])
        cuts = (before[np.searchsorted(starts, np.append(begins, len(joined)))] * 4).tolist()
        blob = ids.astype("<u4").tobytes()
        return [blob[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode_odd(self, text: str) -> bytes:
        from tokenizers import pre_tokenizers
        split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
        return b"".join(self._merge_long(text[a:b].encode()) for _, (a, b) in split)

    def _words_at(self, raw: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every word, and all ids in order."""
        if len(at) > self.known.most:
            half = len(at) // 2
            (a, x), (b, y) = (self._words_at(raw, at[s], size[s]) for s in (slice(half), slice(half, None)))
            return np.concatenate([a, b]), np.concatenate([x, y])
        lanes = _packed(raw, at, size)
        short = size <= 8 * LANES
        slot = np.zeros(len(at), np.int64)
        slot[short] = self.known.find(lanes[short], size[short])
        if (new := np.flatnonzero(short & (slot < 0))).size:
            pick = new[_first_of(lanes[new], size[new])]
            counts, ids = self._merge_short(lanes[pick], size[pick])
            if self.known.full(len(pick)):
                self.known = _WordTable()
                return self._words_at(raw, at, size)
            self.known.add(lanes[pick], size[pick], counts, ids)
            slot[new] = self.known.find(lanes[new], size[new])
        counts, begin = self.known.counts[slot].astype(np.int64), self.known.begins[slot].astype(np.int64)
        long = {i: np.frombuffer(self._merge_long(raw[at[i]:at[i] + size[i]]), "<u4")
                for i in np.flatnonzero(~short).tolist()}
        for i, ids in long.items():
            counts[i] = len(ids)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        begin[~short] = 0
        where = np.arange(total) + np.repeat(begin - (ends - counts), counts)
        if long:
            np.minimum(where, len(self.known.pool) - 1, out=where)
        out = self.known.pool[where] if len(self.known.pool) else np.zeros(total, np.uint32)
        for i, ids in long.items():
            out[ends[i] - counts[i]:ends[i]] = ids
        return counts, out

    def _merge_short(self, lanes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank arrays of many words at once, words of like length together."""
        counts = np.zeros(len(size), np.int64)
        parts: list[np.ndarray] = []
        order = np.argsort(size, kind="stable")
        raw = np.ascontiguousarray(lanes).view(np.uint8).reshape(len(size), -1)
        for at in range(0, len(order), 4096):
            some = order[at:at + 4096]
            merged = self._merge_rows(raw[some, :int(size[some].max())], size[some])
            kept = merged >= 0
            counts[some] = kept.sum(1)
            parts.append(merged[kept])
        # Parts lie in the order of sizes; bring them into the order of the words.
        flat, by_size = np.concatenate(parts), counts[order]
        begin = np.zeros(len(size), np.int64)
        begin[order] = np.cumsum(by_size) - by_size
        where = np.arange(len(flat)) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
        return counts, flat[where]

    def _merge_rows(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of each row's word, -1 behind them."""
        width = raw.shape[1]
        here = np.arange(width)
        ids = self.byte_ids[raw]
        ids[here >= sizes[:, None]] = -1
        done = ids.copy()
        rows = np.arange(len(raw))
        ranks = np.hstack([self.table(ids[:, :-1], ids[:, 1:]), np.full((len(raw), 1), _NONE)])
        while True:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            live = best < _NONE
            if not live.all():
                done[rows[~live]] = ids[~live]
                rows, ids, ranks, at, best = (x[live] for x in (rows, ids, ranks, at, best))
            if not len(rows):
                return done
            each = np.arange(len(rows))
            ids[each, at] = self.merged[best]
            # Deleting a boundary moves what lies behind it one place to the left.
            beyond = np.minimum(here + (here > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, beyond, 1)
            ids[:, -1] = -1
            beyond = np.minimum(here + (here >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, beyond, 1)
            ranks[:, -1] = _NONE
            follow = np.minimum(at + 1, width - 1)
            right = np.where(at + 1 < width, ids[each, follow], -1)
            ranks[each, at] = self.table(ids[each, at], right)
            inner = at > 0
            e, a = each[inner], at[inner]
            ranks[e, a - 1] = self.table(ids[e, a - 1], ids[e, a])

    def _merge_long(self, word: bytes) -> bytes:
        """The same merges with a heap of pairs over a linked list of parts."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := self.rank_of.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (r := self.rank_of.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    # ---- decoding ----

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special tokens included; unknown ids say nothing, bytes that
        are not UTF-8 become U+FFFD."""
        return b"".join([self.token.get(i, b"") for i in ids]).decode("utf-8", "replace")


def _pieces(text: str) -> Iterator[str]:
    """A very long text cut where white space begins, which is a word's end in any case."""
    at = 0
    while len(text) - at > SLICE_CHARS and (m := _word_end.search(text, at + SLICE_CHARS)):
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of bounded length; a longer one is alone."""
    part, chars = [], 0
    for t in texts:
        if part and chars + len(t) > SLICE_CHARS:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    if part:
        yield part


def _word_starts(points: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions where words of the split pattern begin. ``first``: where texts begin."""
    n = len(points)
    before = np.concatenate([[0], classes[:-1]])
    before[first] = 0
    after = np.concatenate([classes[1:], [0]])
    after[first[first > 0] - 1] = 0
    space = classes == _SPACE
    # A run of white space is a word but for its last place if something follows: that place
    # begins a word of its own, which takes in what follows if it is a plain space.
    start = np.where(space, (before != _SPACE) | (after > _SPACE), classes != before)
    plain = np.concatenate([[False], points[:-1] == 0x20])
    plain[first] = False
    start &= space | ~plain
    mark = np.flatnonzero((points == 0x27) & start)
    if len(mark):
        stop = np.append(first[1:], n)[np.searchsorted(first, mark, "right") - 1]
        one, two = (np.where(mark + k < stop, points[np.minimum(mark + k, n - 1)], 0) for k in (1, 2))
        short = np.isin(one, [*map(ord, "stmd")])
        long = np.isin(one * 256 + two, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])
        start[mark[short | long] + 1] = False
        start[(x := mark[short] + 2)[x < n]] = True
        start[(x := mark[long] + 3)[x < n]] = True
    return np.flatnonzero(start)


def _packed(raw: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first bytes of every word as integers, ``LANES`` of them, zero behind its end."""
    padded = raw + bytes(8 * LANES)
    view = np.ndarray((len(raw) + 8 * LANES - 7,), "<u8", padded, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    return np.column_stack([view[at + 8 * k] & masks[np.clip(size - 8 * k, 0, 8)]
                            for k in range(LANES)])


def _mixed(lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(LANES):
        h = (h ^ lanes[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def _first_of(lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One position of every different word."""
    order = np.argsort(_mixed(lanes, size), kind="stable")
    a, b = lanes[order], size[order]
    differs = np.ones(len(order), bool)
    # Words of one hash that alternate may stay twice, which the table settles.
    differs[1:] = (a[1:] != a[:-1]).any(1) | (b[1:] != b[:-1])
    return order[differs]


class _WordTable:
    """Words as packed bytes and size -> their ids, in arrays with open addressing."""

    def __init__(self) -> None:
        n = 1 << SLOT_BITS
        self.lanes, self.sizes = np.zeros((n, LANES), np.uint64), np.zeros(n, np.int16)
        self.counts, self.begins = np.zeros(n, np.int16), np.zeros(n, np.int32)
        self.pool, self.used = np.zeros(0, np.uint32), 0
        self._free = np.zeros(1 << 16, np.uint32)

        self.most = n // 2  # words that it holds

    def full(self, more: int) -> bool:
        return self.used + more > self.most

    def _slot(self, lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (_mixed(lanes, size) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of every word, -1 if it is not there."""
        slot = self._slot(lanes, size)
        open_ = np.arange(len(slot))
        out = np.full(len(slot), -1, np.int64)
        while len(open_):
            at = slot[open_]
            there = self.sizes[at]
            same = (there == size[open_]) & (self.lanes[at] == lanes[open_]).all(1)
            out[open_[same]] = at[same]
            open_ = open_[~same & (there > 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << SLOT_BITS) - 1)
        return out

    def add(self, lanes: np.ndarray, size: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        begin = len(self.pool) + np.cumsum(counts) - counts
        need = len(self.pool) + len(ids)
        if need > len(self._free):
            grown = np.zeros(max(need, 2 * len(self._free)), np.uint32)
            grown[:len(self.pool)] = self.pool
            self._free = grown
        self._free[len(self.pool):need] = ids
        self.pool = self._free[:need]
        self.used += len(size)
        slot, left = self._slot(lanes, size), np.arange(len(size))
        while len(left):
            free = self.sizes[slot[left]] == 0
            _, first = np.unique(slot[left], return_index=True)
            winner = np.zeros(len(left), bool)
            winner[first] = True
            w = left[winner & free]
            self.lanes[slot[w]], self.sizes[slot[w]] = lanes[w], size[w]
            self.counts[slot[w]], self.begins[slot[w]] = counts[w], begin[w]
            left = left[~(winner & free)]
            slot[left] = (slot[left] + 1) & ((1 << SLOT_BITS) - 1)


@lru_cache(maxsize=4)
def codec(spec: str) -> Codec:
    """One codec per worker and vocabulary: it is kept between tasks with its words."""
    return Codec(spec)


def read_spec(path: str) -> str:
    """The vocabulary file's text, read on the driver and sent to the tasks once."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


PART_ROWS = 500  # rows that are coded at a time


def _encoded(coder: Codec, batches: Iterator[pa.RecordBatch], text: str, kept: list[str], out: str
             ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(at, PART_ROWS)
            packed = coder.encode_many(texts_of(part, text))
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), ids], names=[*kept, out])


def _decoded(coder: Codec, batches: Iterator[pa.RecordBatch], ids: str, kept: list[str], out: str
             ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(at, PART_ROWS)
            column = part.column(ids)
            texts = pa.array([None if not column[i].is_valid
                              else coder.decode(column[i].values.to_numpy(zero_copy_only=False).tolist())
                              for i in range(part.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), texts], names=[*kept, out])


def _with(df: DataFrame, kept: list[str], **more: T.DataType) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in kept), *(T.StructField(c, t) for c, t in more.items())])


IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """Adds ``out``: the ids of ``text`` (array<int>), special tokens' strings included.

    Null or empty text has no ids. ``keep`` names the columns to return (default: all); a
    column that is called like ``out`` is replaced. Rows stay as they are, repeated ones too.
    """
    kept = [c for c in (keep if keep is not None else df.columns) if c != out]
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(
        lambda batches: _encoded(codec(spec.value), batches, text, kept, out), _with(df, kept, **{out: IDS}))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the text of the array of ids. Null gives null, no ids the empty text."""
    kept = [c for c in df.columns if c != out]
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    return df.mapInArrow(
        lambda batches: _decoded(codec(spec.value), batches, ids, kept, out),
        _with(df, kept, **{out: T.StringType()}))


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded",
                  keep: list[str] | None = None) -> DataFrame:
    """``encode`` and then ``decode`` of its ids, in one pass through one Python worker per task."""
    kept = [c for c in (keep if keep is not None else df.columns) if c not in (ids, out)]
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(spec.value)
        return _decoded(coder, _encoded(coder, batches, text, kept, ids), ids, [*kept, ids], out)

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(
        run, _with(df, kept, **{ids: IDS, out: T.StringType()}))
