"""WARC archives: written as whole-file gzip streams, normalised to a member per record, and
read back by a sidecar offset index.

Archives are written and read by Spark's own text and binary sources, so they lie wherever
Spark can write. One writing task makes one archive after the other; an archive has a bounded
number of records. The normaliser inflates an archive once, from front to back, and never holds
more than one archive and its compressed members.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORDS_PER_ARCHIVE = 1000
LEVEL = 4               # of the members' compression
BLOCK = 1 << 20         # bytes inflated at a time
VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"        # behind every record
DATE = "2024-01-01T00:00:00Z"
LEAST_REVISIT = 100     # bytes; smaller payloads are not worth a reference

#: One record as read back from a normalised archive.
RECORDS = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType())])


# ---- revisits ----

def with_revisits(rows: DataFrame, key: str, payload: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds _bytes, _digest, _first: size and SHA-256 of the payload in UTF-8 (null: empty), and
    the smallest key of the rows with an equal payload of at least ``least`` bytes if there is
    another such row, else null."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    signed = rows.withColumns({"_bytes": F.octet_length(body).cast("long"), "_digest": F.sha2(body, 256)})
    groups = signed.where(F.col("_bytes") >= least).groupBy("_digest").agg(
        F.count("*").alias("_n"), F.min(key).alias("_first")).where(F.col("_n") > 1)
    return signed.join(groups.select("_digest", "_first"), "_digest", "left")


# ---- writing ----

def _header(name: str, value: Column) -> Column:
    """A header line, nothing for null; line breaks in the value become spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(rows: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   payload: str = "html", records: int = RECORDS_PER_ARCHIVE) -> None:
    """Writes monolithic gzip archives, a record per row.

    Of rows with equal payloads the one with the smallest key is a response; the others are
    revisits without a body that name it. Null keys are written as an absent header, null urls
    too; rows that share the smallest key are all responses.
    """
    marked = with_revisits(rows.select(rows[key].alias("_key"), rows[url].alias("_url"),
                                       rows[payload].alias("_payload")), "_key", "_payload")
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_key"))
    record = F.concat(
        F.lit(VERSION.decode()),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(
            "\n", F.col("_key").cast("string"), F.col("_url"), F.col("_digest")).cast("binary"), 256), F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("_url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        _header("X-Payload-Length", F.col("_bytes")),
        _header("X-Page-Key", F.col("_key")),
        _header("X-Refers-To-Key", F.when(revisit, F.col("_first"))),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("_bytes"))),
        F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.coalesce("_payload", F.lit(""))))
    (marked.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", records).text(folder))


# ---- normalising ----

def _inflate(raw: bytes) -> Iterator[bytes]:
    """The content of a gzip stream in blocks; further members follow on."""
    at = memoryview(raw)
    while len(at):
        stream = zlib.decompressobj(31)
        pending = bytes(at)
        while pending and not stream.eof:
            yield stream.decompress(pending, BLOCK)
            pending = stream.unconsumed_tail
        if not stream.eof:
            yield stream.flush()
            if not stream.eof:
                raise ValueError("the gzip stream ends too early")
        at = memoryview(stream.unused_data)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def records_of(raw: bytes) -> Iterator[bytes]:
    """Every record of a gzip archive with the line ends behind it, inflating it once."""
    blocks, held, done = _inflate(raw), bytearray(), False
    need = 0
    while True:
        end = held.find(b"\r\n\r\n") if not need else 0
        if not need and end >= 0 and held:
            if not held.startswith(VERSION):
                raise ValueError("no WARC record where one should begin")
            need = end + 4 + int(_headers(bytes(held[:end])).get("Content-Length", 0)) + len(END)
        if need and len(held) >= need:
            yield bytes(held[:need])
            del held[:need]
            need = 0
            continue
        if done:
            if held:
                raise ValueError("the last record is cut off")
            return
        more = next(blocks, None)
        if more is None:
            done = True
        else:
            held += more


def member(record: bytes) -> bytes:
    """A gzip member whose last byte is zero, as the archive's text sink ends it with one. That
    byte is the highest of the record's size; a larger record gets an empty member behind it."""
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = pack.compress(record) + pack.flush()
    if out[-1]:
        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += pack.flush()
    return out


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrites every archive of ``source`` record by record.

    ``target`` gets, by archive, a file with a gzip member per record (kind=warc) and a
    sidecar index, gzip too, of lines ``offset length`` in the records' order (kind=cdx).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, raw in zip(frame["name"], frame["content"], strict=True):
                offset, index, out, size = 0, [], [], 0
                for n, record in enumerate(records_of(bytes(raw))):
                    packed = member(record)
                    index.append(f"{offset} {len(packed)}\n")
                    offset += len(packed)
                    out.append(("warc", name, n, packed[:-1]))
                    size += len(packed)
                    if size > 4 * BLOCK:
                        yield pd.DataFrame(out, columns=["kind", "archive", "n", "bytes"])
                        out, size = [], 0
                out.append(("cdx", name, 0, member("".join(index).encode())[:-1]))
                yield pd.DataFrame(out, columns=["kind", "archive", "n", "bytes"])

    name = F.regexp_extract("path", r"([^/]+?)(?:\.[a-z]+)*$", 1)
    rows = files.select(name.alias("name"), "content").mapInPandas(
        run, "kind string, archive string, n long, bytes binary")
    # The sink ends every row by a zero byte: the last byte of its member.
    (rows.sortWithinPartitions("kind", "archive", "n")
     .select("kind", "archive", F.col("bytes").cast("string").alias("value"))
     .write.partitionBy("kind", "archive").option("lineSep", "\0").text(target))


# ---- reading ----

def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of normalised archives (see ``RECORDS``), each inflated by its index entry."""
    files = (spark.read.format("binaryFile").load(folder)
             .select("kind", F.col("archive").cast("string").alias("archive"), "content"))

    def run(parts: pd.DataFrame) -> pd.DataFrame:
        content = dict(zip(parts["kind"], parts["content"], strict=True))
        archive = content["warc"] if "warc" in content else b""
        rows = []
        for line in zlib.decompress(content["cdx"], 31).decode().splitlines():
            offset, length = map(int, line.split())
            record = zlib.decompressobj(31).decompress(archive[offset:offset + length])
            head, _, rest = record.partition(b"\r\n\r\n")
            headers = _headers(head)
            rows.append((parts["archive"].iloc[0], offset, length, headers,
                         rest[:int(headers.get("Content-Length", 0))]))
        return pd.DataFrame(rows, columns=RECORDS.names)

    return files.groupBy("archive").applyInPandas(run, RECORDS)
