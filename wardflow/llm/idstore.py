"""Token ids in raw files with keyed access: a minimal perfect hash index over the keys.

A store is a folder. ``payload`` has shard files of ids and nothing else (little-endian, two
bytes each where the vocabulary allows it, else four), documents in the order of their keys,
and beside each shard the offsets of its documents (64-bit numbers of ids, one more than there
are documents). ``index`` has files of a minimal perfect hash function each, for the keys whose
hash falls to it: levels of bits, where a key is at home in the first level in which it met no
other key; its slot is the number of bits set before. The slot's record has the key's
fingerprint, shard, place and number of documents. ``manifest`` and ``buckets`` are tables of
the files that count: a task that was lost may leave a file, but no row.

Access by key costs one probe of the index and one seek, whatever the size of the store.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import scratch
from wardflow.llm.bpe import _pieces, byte_letters, read_spec

SHARD_BYTES = 64 << 20     # of text, about
KEYS_PER_BUCKET = 1 << 18  # about
SPARSENESS = 2             # bits of a level for each key that comes to it
READ_BYTES = 8 << 20       # that are read at a time
RUN = 4096                 # documents of a shard that one task reads
CHUNKS = 1 << 19           # different chunks of text whose ids a Python worker keeps, 100 MB
LONG = 64                  # bytes of a chunk from which its ids are not kept
RECORD = np.dtype([("fingerprint", "<u8"), ("shard", "<i8"), ("place", "<i8"), ("rows", "<i8")])
SPAN = np.dtype([("slot", "<i8"), ("shard", "<i8"), ("place", "<i8"), ("rows", "<i8")])


# ---- files ----

def _file(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _folder(path: str) -> None:
    system, at = _file(path)
    system.create_dir(at, recursive=True)


# ---- encoding ----

# A word of Latin-1 letters and the plain marks behind it: the splitter parts them, and nothing
# in them is composed or changed but for the case of single letters.
_plain = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


class Encoder(dict):
    """Ids of whole texts by the tokenizers library, as bytes of ``width`` each.

    For vocabularies that lower-case and whose splitting never joins what ASCII white space
    separates: a text's ids are those of its chunks between white space, one after the other. The
    mapping keeps the ids of chunks; plain words go straight to the library's model, everything
    else through its whole chain.
    """

    def __init__(self, spec: str, width: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = byte_letters()
        self.code = "H" if width == 2 else "I"
        normal = json.loads(spec).get("normalizer") or {}
        steps = {n["type"] for n in normal.get("normalizers", [normal]) if n}
        self.lower = "Lowercase" in steps

    def encode(self, text: str | None) -> bytes:
        return b"".join([self._piece(p) for p in _pieces(text or "")])

    def _piece(self, text: str) -> bytes:
        if len(self) > CHUNKS:
            self.clear()
        return b"".join(map(self.__getitem__, text.encode().split()))

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.lower and (m := _plain.fullmatch(text)):
            word, marks = m[1].lower(), m[2]
            if marks or word != text:
                found = self[word.encode()] + (self[marks.encode()] if marks else b"")
            else:
                shown = word if word.isascii() else "".join([self.letters[b] for b in chunk])
                found = self._packed([t.id for t in self.library.model.tokenize(shown)])
        else:
            found = self._packed(self.library.encode(text, add_special_tokens=False).ids)
        if len(chunk) <= LONG:
            self[chunk] = found
        return found

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)


def id_width(spec: str, end_id: int | None) -> int:
    """Bytes of an id: two if every id fits."""
    data = json.loads(spec)
    most = max([*data["model"]["vocab"].values(), *(t["id"] for t in data.get("added_tokens", [])), end_id or 0])
    return 2 if most < 1 << 16 else 4


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(spec: str, width: int) -> Encoder:
    """One per Python worker and vocabulary."""
    if (spec, width) not in _encoders:
        _encoders[spec, width] = Encoder(spec, width)
    return _encoders[spec, width]


# ---- minimal perfect hashing ----

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class PerfectHash:
    """Keys given as two 64-bit hashes -> 0 to n - 1, each once."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.begins = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        if len(np.unique(np.column_stack([a, b]), axis=0)) != len(a):
            raise ValueError("two keys have the same hashes")
        sizes, parts = [], []
        while len(a):
            size = -(-SPARSENESS * len(a) // 64) * 64
            at = cls._place(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            sizes.append(size)
            parts.append(np.packbits(bits, bitorder="little").view("<u8"))
            a, b = a[~alone], b[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(a + np.uint64(level) * (b | np.uint64(1))) % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of every key; for strangers any slot or -1."""
        out, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (size, begin) in enumerate(zip(self.sizes.tolist(), self.begins.tolist(), strict=True)):
            if not len(open_):
                break
            at = begin + self._place(a[open_], b[open_], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            home = (word >> bit & np.uint64(1)) == 1
            low = word[home] & ((np.uint64(1) << bit[home]) - np.uint64(1))
            out[open_[home]] = self.before[at[home] >> 6] + np.bitwise_count(low)
            open_ = open_[~home]
        return out


class Index:
    """One file of the index. A key's first run of documents is in its record; a key whose
    documents go on in other shards has a span for each of those."""

    def __init__(self, hashed: PerfectHash, records: np.ndarray, spans: np.ndarray) -> None:
        self.hashed, self.records, self.spans = hashed, records, spans

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, shard: np.ndarray, place: np.ndarray, rows: np.ndarray) -> Index:
        """A row per key and shard."""
        order = np.lexsort((place, shard, b, a))
        a, b, shard, place, rows = (x[order] for x in (a, b, shard, place, rows))
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        hashed = PerfectHash.build(a[first], b[first])
        slots = hashed.slots(a, b)
        records, spans = np.zeros(int(first.sum()), RECORD), np.zeros(int((~first).sum()), SPAN)
        for name, column in (("fingerprint", b), ("shard", shard), ("place", place), ("rows", rows)):
            records[name][slots[first]] = column[first]
        for name, column in (("slot", slots), ("shard", shard), ("place", place), ("rows", rows)):
            spans[name] = column[~first]
        return cls(hashed, records, np.sort(spans, order=["slot", "shard"]))

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are there, and their runs: (number of the key, shard, place, rows)."""
        slots = self.hashed.slots(a, b)
        known = slots >= 0
        known[known] = self.records["fingerprint"][slots[known]] == b[known]
        at = np.flatnonzero(known)
        found = [np.stack([at, *(self.records[c][slots[at]] for c in ("shard", "place", "rows"))], 1)]
        if len(self.spans) and len(at):
            low, high = (np.searchsorted(self.spans["slot"], slots[at], side) for side in ("left", "right"))
            which = np.repeat(at, high - low)
            span = np.concatenate([np.arange(x, y) for x, y in zip(low, high, strict=True)])
            found.append(np.stack([which, *(self.spans[c][span] for c in ("shard", "place", "rows"))], 1))
        return known, np.concatenate(found)

    def save(self, path: str) -> None:
        system, at = _file(path)
        counts = (len(self.hashed.sizes), len(self.hashed.words), len(self.records), len(self.spans))
        with system.open_output_stream(at) as out:
            for part in (np.array(counts, "<i8"), self.hashed.sizes.astype("<i8"), self.hashed.words.astype("<u8"),
                         self.records, self.spans):
                out.write(part.tobytes())

    @classmethod
    def load(cls, path: str) -> Index:
        system, name = _file(path)
        with system.open_input_stream(name) as file:
            raw = file.read()
        levels, words, keys, spans = np.frombuffer(raw, "<i8", 4).tolist()
        at, parts = 32, []
        for kind, n in ((np.dtype("<i8"), levels), (np.dtype("<u8"), words), (RECORD, keys), (SPAN, spans)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * kind.itemsize
        return cls(PerfectHash(*parts[:2]), *parts[2:])


def _hashes(key: Column) -> list[Column]:
    """Two independent hashes of any key, null included."""
    name = key.cast("string")
    return [F.xxhash64(name).alias("a"), F.xxhash64(F.lit("fingerprint"), name).alias("b")]


# ---- writing ----

def write_store(docs: DataFrame, root: str, path: str, key: str = "doc_id", text: str = "text",
                end_id: int | None = 1, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every row's text with the vocabulary file ``path`` and write the store.

    Documents lie in ascending order of ``key`` (nulls first; equal keys by the number of bytes of
    their texts, then an XXH64 of them). ``end_id`` follows every text; null and empty ones consist
    of it. Repeated keys and repeated rows are kept: a key has as many documents as rows. No rows
    give a store without files. Other columns play no part.

    Texts are moved once, to shards of about ``shard_bytes`` of text, and encoded where they are
    written. A key with many rows is spread over shards like any other rows.
    """
    spark = docs.sparkSession
    # A row's number only parts equal rows, so it does not matter which of them gets which.
    rows = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text")).withColumns({
        "size": F.octet_length("text"), "sign": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    total = rows.agg(F.sum("size")).first()[0] or 0
    folder = f"{root}/payload"
    _folder(folder)
    _folder(f"{root}/index")
    order = [F.col("key").asc_nulls_first(), F.col("size"), F.col("sign"), F.col("row")]
    shards = rows.repartitionByRange(max(1, -(-total // shard_bytes)), *order).sortWithinPartitions(*order)
    kind = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("shard", T.LongType()),
        T.StructField("file", T.StringType()), T.StructField("place", T.LongType()),
        T.StructField("rows", T.LongType()), T.StructField("n", T.LongType())])
    spec = spark.sparkContext.broadcast(read_spec(path))
    # A row per key and shard, committed by Spark: it names the file of the attempt that counts.
    entries = scratch.materialise(
        shards.select("key", "text").mapInArrow(_writer(folder, spec, end_id), kind), "idstore-entries")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    manifest = entries.groupBy("shard", "file").agg(
        F.sum("rows").alias("docs"), F.sum("n").alias("n_ids")).withColumn(
        "base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long")))
    manifest.withColumn("width", F.lit(id_width(spec.value, end_id))).write.parquet(f"{root}/manifest")

    keys = entries.select(*_hashes(F.col("key")), "shard", "place", "rows")
    buckets = max(1, -(-entries.count() // KEYS_PER_BUCKET))
    built = keys.groupBy(_bucket(buckets).alias("bucket")).applyInPandas(
        _builder(f"{root}/index"), "bucket long, file string, keys long, buckets long")
    built.withColumn("buckets", F.lit(buckets).cast("long")).write.parquet(f"{root}/buckets")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("a", "b"), F.lit(buckets))


def _writer(folder: str, spec: Broadcast, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = TaskContext.get().partitionId(), None
        width = id_width(spec.value, end_id)
        tail = b"" if end_id is None else int(end_id).to_bytes(width, "little")
        sizes: list[np.ndarray] = [np.zeros(1, np.int64)]
        out, place = None, 0
        run: list | None = None  # key, first place, rows, ids

        def batch(runs: list[list], kind: pa.DataType) -> pa.RecordBatch:
            keys, places, rows, ns = zip(*runs, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array([shard] * len(runs), pa.int64()), pa.array([name] * len(runs)),
                 *(pa.array(x, pa.int64()) for x in (places, rows, ns))],
                names=["key", "shard", "file", "place", "rows", "n"])

        try:
            for part in batches:
                if not part.num_rows:
                    continue
                if out is None:
                    coder, name = _encoder(spec.value, width), f"shard-{shard:08d}-{uuid.uuid4().hex}"
                    system, at = _file(f"{folder}/{name}.ids")
                    out = system.open_output_stream(at)
                n = []
                for text in part.column("text"):
                    ids = coder.encode(text.as_py()) + tail
                    out.write(ids)
                    n.append(len(ids) // width)
                sizes.append(np.array(n, np.int64))
                done = []
                for key, ids in zip(part.column("key").to_pylist(), n, strict=True):
                    if run is None or key != run[0]:
                        if run is not None:
                            done.append(run)
                        run = [key, place, 0, 0]
                    run[2] += 1
                    run[3] += ids
                    place += 1
                kind = part.schema.field("key").type
                if done:
                    yield batch(done, kind)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            system, at = _file(f"{folder}/{name}.offsets")
            with system.open_output_stream(at) as offsets:
                offsets.write(np.cumsum(np.concatenate(sizes)).astype("<u8").tobytes())
            yield batch([run], kind)

    return run


def _builder(folder: str):
    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = (rows[c].to_numpy(np.int64).view(np.uint64) for c in "ab")
        index = Index.build(a, b, *(rows[c].to_numpy(np.int64) for c in ("shard", "place", "rows")))
        name = f"index-{int(group[0]):08d}-{uuid.uuid4().hex}"
        index.save(f"{folder}/{name}.mph")
        return pd.DataFrame([(int(group[0]), name, len(index.records), 0)],
                            columns=["bucket", "file", "keys", "buckets"])

    return run


# ---- reading ----

def locate(keys: DataFrame, root: str, key: str = "doc_id") -> DataFrame:
    """``key``, shard, place, rows: where each given key's documents lie, a row for every shard with
    some. Keys are probed one by one in the index; those that are not in the store have no row (a
    stranger passes for a key with a chance of 2^-64). Keys should be distinct; null is a key."""
    spark = keys.sparkSession
    buckets = spark.read.schema("bucket long, file string, keys long, buckets long").parquet(f"{root}/buckets")
    count = buckets.agg(F.max("buckets")).first()[0] or 1
    asked = keys.select(keys[key].alias("key"), *_hashes(keys[key]))
    asked = asked.withColumn("bucket", _bucket(count)).join(buckets.select("bucket", "file"), "bucket")
    asked = asked.repartition("bucket").sortWithinPartitions("bucket")
    kind = T.StructType([T.StructField("key", keys.schema[key].dataType),
                         *(T.StructField(c, T.LongType()) for c in ("shard", "place", "rows"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, index = None, None
        for batch in batches:
            files = batch.column("file").to_pylist()
            cuts = [i for i in range(len(files)) if i == 0 or files[i] != files[i - 1]] + [len(files)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if files[x] != now:
                    now, index = files[x], Index.load(f"{root}/index/{files[x]}.mph")
                part = batch.slice(x, y - x)
                a, b = (part.column(c).to_numpy().view(np.uint64) for c in "ab")
                _, found = index.find(a, b)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(found[:, 0])), *(pa.array(found[:, c]) for c in (1, 2, 3))],
                    names=["key", "shard", "place", "rows"])

    return asked.select("key", "a", "b", "file").mapInArrow(run, kind).withColumnRenamed("key", key)


def read_keys(keys: DataFrame, root: str, key: str = "doc_id") -> DataFrame:
    """``key``, start (ids of all documents before), n_ids, ids (packed little-endian unsigned 32-bit):
    every document of the given distinct keys, by seeks to where the index says."""
    spark = keys.sparkSession
    places = locate(keys, root, key).withColumnRenamed(key, "key")
    files = spark.read.schema(
        "shard long, file string, docs long, n_ids long, base long, width int").parquet(f"{root}/manifest")
    # Neighbours are read together by one task, a few thousand documents of a shard each.
    named = places.join(files.select("shard", "file", "base", "width"), "shard").repartition(
        F.col("shard"), F.floor(F.col("place") / RUN)).sortWithinPartitions("shard", "place")
    kind = T.StructType([T.StructField("key", keys.schema[key].dataType), T.StructField("start", T.LongType()),
                         T.StructField("n_ids", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(f"{root}/payload")
        try:
            for batch in batches:
                kind = batch.schema.field("key").type
                columns = [batch.column(c).to_pylist() for c in ("key", "file", "place", "rows", "base", "width")]
                for found in reader.read(list(zip(*columns, strict=True))):
                    ks, starts, ns, ids = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ks, kind), pa.array(starts, pa.int64()), pa.array(ns, pa.int64()),
                         pa.array(ids, pa.binary())], names=["key", "start", "n_ids", "ids"])
        finally:
            reader.close()

    return named.select("key", "file", "place", "rows", "base", "width").mapInArrow(
        run, kind).withColumnRenamed("key", key)


class _Reader:
    """Documents of shards that are asked for in the order of their places."""

    def __init__(self, folder: str) -> None:
        self.folder, self.name, self.payload, self.offsets = folder, None, None, None

    def _open(self, name: str) -> None:
        if name != self.name:
            self.close()
            for kind in ("ids", "offsets"):
                system, at = _file(f"{self.folder}/{name}.{kind}")
                setattr(self, "payload" if kind == "ids" else kind, system.open_input_file(at))
            self.name = name

    def close(self) -> None:
        for file in (self.payload, self.offsets):
            if file is not None:
                file.close()

    def read(self, asked: list[tuple]) -> Iterator[list[tuple]]:
        """Rows (key, file, place, rows, base, width) -> lists of (key, start, ids' number, ids)."""
        at = 0
        while at < len(asked):
            end = at + 1  # runs that follow one another are one
            while end < len(asked) and asked[end][1] == asked[at][1] and (
                    asked[end][2] == asked[end - 1][2] + asked[end - 1][3]):
                end += 1
            keys = [r[0] for r in asked[at:end] for _ in range(r[3])]
            _, name, place, _, base, width = asked[at]
            self._open(name)
            ends = np.frombuffer(self.offsets.read_at(8 * (len(keys) + 1), 8 * place), "<u8").astype(np.int64)
            low = 0
            while low < len(keys):
                high = max(low + 1, int(np.searchsorted(ends, ends[low] + READ_BYTES // width, "right")) - 1)
                raw = self.payload.read_at(int(ends[high] - ends[low]) * width, int(ends[low]) * width)
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                cuts = ((ends[low:high + 1] - ends[low]) * 4).tolist()
                starts = (base + ends[low:high]).tolist()
                yield [(k, s, (y - x) // 4, ids[x:y]) for k, s, x, y in
                       zip(keys[low:high], starts, cuts, cuts[1:], strict=False)]
                low = high
            at = end
