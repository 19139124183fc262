"""WARC archives: written as whole-file gzip, rewritten with one member a record, read by offset.

``write_monolithic`` leaves what many crawlers leave: one gzip stream over a whole file, in
which no record can be reached without inflating all before it. ``normalise`` inflates each
stream once, rewrites every record as its own gzip member and writes a sidecar index of
offsets. ``read_records`` then splits archives at any member.
"""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
LENGTH_FIELD = "X-Payload-Length"

MIN_REVISIT_BYTES = 1000
RUN_BYTES = 64 << 20
CHUNK = 1 << 16
INDEX = "archive string, offset long, length long, record_type string, record_id string"
RECORDS = (
    "archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_length long, payload binary"
)


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to``.

    Of equal payloads of at least ``min_bytes`` the largest page_id is kept, the others refer
    to it. A NULL html is an empty payload. Rows that repeat the kept page_id are kept too; a
    NULL page_id refers to the largest known one, and is kept where its group has none.
    Digests are counted on narrow rows first; only digests found twice reach the join, as a
    written table, so that a payload that fills a third of the rows is split.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    keep = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_keep"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    rows = rows.join(saved(keep, "warc-keep"), F.col("payload_digest") == F.col("_digest"), "left")
    other = F.col("_keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keep"))
    return rows.withColumn("refers_to", F.when(other, F.col("_keep"))).drop("_digest", "_keep")


def write_monolithic(rows: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives of ``rows`` (see ``revisits``) below ``path``, each one gzip stream.

    A response carries an HTTP head and the payload, a revisit the head alone. The row
    separator of the text writer is what ends a record.
    """
    revisit = F.col("refers_to").isNotNull()

    def uri(c):
        return F.concat(F.lit(f"<{ID_PREFIX}"), F.col(c).cast("string"), F.lit(">"))

    def field(name, value):
        value = F.regexp_replace(value, "[\r\n]+", " ")
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\n"),
        field("WARC-Record-ID", uri("page_id")),
        F.lit(f"WARC-Date: {date}\r\n"),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Refers-To", uri("refers_to")),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field(LENGTH_FIELD, F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n")
    writer.option("compression", "gzip").text(path)


class _Lines:
    """Bytes of one stream, from lines that lost their line feed."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest = lines, b""

    def line(self) -> bytes | None:
        if self.rest:
            out, self.rest = self.rest, b""
            return out
        got = next(self.lines, None)
        return None if got is None else got + b"\n"

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            got = self.line()
            if got is None:
                raise EOFError("the stream ends inside a record")
            part, self.rest = got[:n], got[n:]
            n -= len(part)
            yield part


def _head(lines: _Lines) -> tuple[bytes, dict[str, str]] | None:
    """The next record's head, raw and by lower-case field; what is no head is passed over."""
    while (got := lines.line()) is not None:
        if not got.startswith(b"WARC/"):
            continue
        raw, fields = [got], {}
        while (got := lines.line()) is not None:
            raw.append(got)
            if not got.strip():
                break
            name, _, value = got.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        return b"".join(raw), fields
    return None


def _store(uri: str):
    return pafs.FileSystem.from_uri(uri)


def _put(file, data: bytes) -> int:
    file.write(data)
    return len(data)


def _rewriter(out: str, level: int):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(out)
        attempt = TaskContext.get().taskAttemptId()
        rows = (
            (f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        )
        ahead = next(rows, None)
        while ahead is not None:
            source = ahead[0]

            def own() -> Iterator[bytes]:
                nonlocal ahead
                while ahead is not None and ahead[0] == source:
                    value, ahead = ahead[1], next(rows, None)
                    yield value

            name = re.sub(r"(\.txt|\.warc)?\.gz$", "", source.rsplit("/", 1)[-1]) + ".warc.gz"
            lines, at, n = _Lines(own()), 0, 0
            temp = f"{root}/_{attempt}-{name}"
            with store.open_output_stream(temp, compression=None) as data, store.open_output_stream(
                f"{temp}.idx", compression=None
            ) as index:
                while (head := _head(lines)) is not None:
                    raw, fields = head
                    # a member of its own, with no time in its head: a repeated task writes equal bytes
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    size = _put(data, pack.compress(raw))
                    for part in lines.take(int(fields.get("content-length", 0))):
                        size += _put(data, pack.compress(part))
                    size += _put(data, pack.compress(b"\r\n\r\n") + pack.flush())
                    entry = {
                        "archive": name,
                        "offset": at,
                        "length": size,
                        "record_type": fields.get("warc-type"),
                        "record_id": fields.get("warc-record-id"),
                    }
                    index.write(json.dumps(entry).encode() + b"\n")
                    at, n = at + size, n + 1
            store.move(temp, f"{root}/{name}")
            store.move(f"{temp}.idx", f"{root}/{name}.idx")
            yield pa.RecordBatch.from_pydict(
                {"archive": [name], "records": pa.array([n], pa.int64()), "bytes": pa.array([at], pa.int64())}
            )

    return rewrite


def normalise(spark: SparkSession, source: str, out: str, level: int = 6) -> DataFrame:
    """Every ``*.gz`` below ``source`` rewritten below ``out``: ``archive, records, bytes`` of each.

    A whole-file stream can only be inflated from its start, so a task takes whole files; it
    holds one line of a record at a time. Each file goes to a name of its attempt first and
    is moved when whole, so lost or doubled tasks leave the same archives.
    """
    store, root = _store(out)
    store.create_dir(root, recursive=True)
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(source)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    return saved(lines.mapInArrow(_rewriter(out, level), "archive string, records long, bytes long"), "warc-files")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar entries of the archives below ``folder``: one row a record."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(folder)


def parse(member: bytes) -> dict:
    """One inflated record."""
    head, _, block = member.partition(b"\r\n\r\n")
    fields = {}
    for row in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = row.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = block[: int(fields.get("content-length", 0))]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    length = fields.get(LENGTH_FIELD.lower())
    return {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest"),
        "payload_length": None if length is None else int(length),
        "payload": block,
    }


def _reader(folder: str):
    shape = pa.schema(
        [(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
         for n, t in (c.split() for c in RECORDS.split(", "))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, file, rows, held = None, None, [], 0
        for batch in batches:
            for at in batch.to_pylist():
                if at["archive"] != name:
                    if file is not None:
                        file.close()
                    name = at["archive"]
                    file = store.open_input_file(f"{root}/{name}")
                file.seek(at["offset"])
                row = parse(gzip.decompress(file.read(at["length"])))
                rows.append({"archive": name, "offset": at["offset"], **row})
                held += len(row["payload"])
                if held > 8 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, shape)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, shape)
        if file is not None:
            file.close()

    return read


def read_records(spark: SparkSession, folder: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """All records below ``folder``, by their sidecar index.

    Archives are cut into runs of ``run_bytes``, so that one large archive is read by many tasks. Index rows
    are narrow, so tasks are counted by the bytes that they stand for.
    """
    index = saved(read_index(spark, folder).select("archive", "offset", "length"), "warc-index")
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // run_bytes) + 1
    runs = index.repartition(tasks, "archive", F.floor(F.col("offset") / run_bytes))
    return runs.sortWithinPartitions("archive", "offset").mapInArrow(_reader(folder), RECORDS)
