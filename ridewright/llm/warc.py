"""WARC archives: whole-file gzip streams rewritten as one gzip member per record, with an offset index.

Spark's text writer lays down archives whose whole file is a single gzip stream, the form that has to
be normalised. The normaliser inflates each file once from front to back, cuts it into records by
their lengths, writes every record as a gzip member of its own and notes where each member begins.
Records are then read back by offset from the normalised archives alone.
"""

from __future__ import annotations

import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches
from ridewright.session import scratch_path

RECORDS_PER_ARCHIVE = 2_000
LEVEL = 3
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
# The record types and headers of the archive format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: 160 bits are 32 letters of five bits, read from the hex digits in groups of five."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        number = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to): refers_to is null for a response.

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest id is the response and the
    others refer to it; further rows with that id are responses too. A null payload counts as empty, a
    null id is smaller than any other; if all ids of a payload are null, all are responses.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload").cast("long")})
    head = rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.max("page_id").alias("head"))
    head = head.where("n > 1 and head is not null").drop("n")
    return rows.join(head, ["digest", "bytes"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        "bytes",
        F.when(F.col("page_id").eqNullSafe(F.col("head")), None).otherwise(F.col("head")).alias("refers_to"),
    )


def record_text(row: dict[str, Column]) -> Column:
    """A record up to its closing blank lines; a revisit has no payload but names size and digest."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    clean = F.regexp_replace(F.coalesce(row["url"], F.lit("")), r"[\r\n]", " ")
    body = F.when(row["refers_to"].isNull(), row["payload"]).otherwise("")
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(row["refers_to"].isNull(), "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">\r\n")),
        line("WARC-Target-URI", clean),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), row["digest"])),
        line("X-Payload-Length", row["bytes"]),
        F.coalesce(line("X-Page-ID", row["page_id"]), F.lit("")),
        F.when(
            row["refers_to"].isNotNull(),
            F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"), line("X-Refers-To-Page-ID", row["refers_to"])),
        ).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
        body,
    )


def write_monolithic(rows: DataFrame, folder: str, per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """Write :func:`records` as archives of at most ``per_archive`` records, each file one gzip stream."""
    text = record_text({c: F.col(c) for c in rows.columns})
    (
        rows.select(text.alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_archive)
        .text(folder)
    )


def split_records(data: bytearray) -> Iterator[bytes]:
    """Take whole records off the front of ``data``; what is not whole yet stays in it."""
    at = 0
    while (head := data.find(b"\r\n\r\n", at)) >= 0:
        length = 0
        for line in bytes(data[at:head]).split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                length = int(value)
        end = head + 4 + length + 4
        if end > len(data):
            break
        yield bytes(data[at:end])
        at = end
    del data[:at]


def inflate(content: memoryview) -> Iterator[bytes]:
    """The bytes of a gzip file in bounded pieces, over all its members."""
    engine, at = zlib.decompressobj(31), 0
    rest = b""
    while at < len(content) or rest:
        if not rest:
            rest = bytes(content[at : at + CHUNK])
            at += len(rest)
        piece = engine.decompress(rest, 4 * CHUNK)
        if engine.eof:
            rest, engine = engine.unused_data, zlib.decompressobj(31)
        else:
            rest = engine.unconsumed_tail
        if piece:
            yield piece


def member(record: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return engine.compress(record) + engine.flush()


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if urlparse(folder).scheme else f"file://{folder}")


INDEX = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("page_id", T.LongType()),
    ]
)


def header(block: bytes) -> dict[bytes, bytes]:
    lines = block.split(b"\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (x.partition(b":") for x in lines)}


def _rewrite(target: str):
    """Per archive: inflate the stream once, write one member per record, yield its index entries."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(target)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = path.rsplit("/", 1)[1].split(".")[0] + ".warc.gz"
                partial, found, offset, data = f"{root}/.{name}.{attempt}", [], 0, bytearray()
                with system.open_output_stream(partial, compression=None) as out:
                    for piece in inflate(memoryview(content.as_buffer())):
                        data += piece
                        for record in split_records(data):
                            page = header(record[: record.find(b"\r\n\r\n")]).get(b"x-page-id")
                            packed = member(record)
                            out.write(packed)
                            found.append((name, len(found), offset, len(packed), int(page) if page else None))
                            offset += len(packed)
                if data:
                    raise ValueError(f"{path} ends inside a record")
                system.move(partial, f"{root}/{name}")  # a repeated task replaces the file by an equal one
                yield pa.RecordBatch.from_pydict(
                    {f.name: pa.array(v, pa.string() if i == 0 else pa.int64()) for (i, f), v in zip(enumerate(INDEX), zip(*found), strict=True)}
                    if found
                    else {f.name: pa.array([], pa.string() if i == 0 else pa.int64()) for i, f in enumerate(INDEX)}
                )

    return step


def normalise(spark: SparkSession, source: str, target: str, index: str) -> DataFrame:
    """Rewrite all archives of ``source`` below ``target``; the sidecar index is a table at ``index``."""
    system, root = _place(target)
    system.create_dir(root, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")
    map_batches(files, _rewrite(target), INDEX, rows=1).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _fetch(folder: str, with_payload: bool):
    """Read the records that index rows point at, each by its own seek; checks payload and digest."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            for archive, offset, length in zip(*columns, strict=True):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, system.open_input_file(f"{root}/{archive}")
                rows.append(_parse(zlib.decompress(source.read_at(length, offset), 31), with_payload))
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORD)
        if source is not None:
            source.close()

    return step


ARROW_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _parse(record: bytes, with_payload: bool) -> dict:
    end = record.find(b"\r\n\r\n")
    fields = header(record[:end])
    number = lambda key: int(fields[key]) if key in fields else None
    kind, body = fields[b"warc-type"].decode(), record[end + 4 : end + 4 + int(fields[b"content-length"])]
    size, digest = number(b"x-payload-length"), fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response":
        size, found = len(body), b32encode(sha1(body).digest()).decode()
        if found != digest:
            raise ValueError(f"payload of record {fields[b'warc-record-id']!r} does not match its digest")
    return {
        "page_id": number(b"x-page-id"),
        "url": fields[b"warc-target-uri"].decode(),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number(b"x-refers-to-page-id"),
        "payload": body if with_payload and kind == "response" else None,
    }


def read_back(index: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records that rows of a sidecar index name, in any selection of them."""
    return map_batches(index.select("archive", "offset", "length"), _fetch(folder, with_payload), RECORD)


def archive(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    folder: str | None = None,
) -> tuple[str, DataFrame]:
    """Write pages as whole-file gzip archives, normalise them; (normalised folder, sidecar index).

    See :func:`records` for equal payloads, nulls and repeated rows. Ids are whole numbers; other columns
    of ``pages`` are not archived. An empty table gives no archives and an empty index.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    raw, members, index = f"{folder}/raw", f"{folder}/members", f"{folder}/index"
    write_monolithic(records(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, min_bytes=min_bytes), raw)
    return members, normalise(spark, raw, members, index)
