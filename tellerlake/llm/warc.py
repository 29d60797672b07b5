"""WARC archives as a PySpark data source, and the archiving of pages.

`spark.read.format("warc")` and `df.write.format("warc")`, after `register(spark)`.

Writing: each task writes files of its own, a gzip member for each record, and reports
their names; the commit lists them in one manifest, so files of failed or repeated attempts
are never read. A member's header holds its length.

Reading: files are packed into partitions by size. Filters on record type and on the other
header columns reach the reader. It inflates a record's headers first; if they don't pass,
or payloads are not wanted (option payload=false), it goes on to the next member without
inflating the rest. Archives of other origin, compressed or not, are read from start to
end; of what they hold, unwanted payloads are passed over without being kept. A directory
without a manifest is read file by file (*.warc, *.warc.gz).

Folders are opened through pyarrow's file systems on driver and executors (local, HDFS and
object stores), since Python data sources have no access to Spark's own.

Defined results of archiving: a null html is an empty payload; a null url has no target
header and comes back null; a url with control
characters, white space or letters outside ASCII is percent-encoded; a row without page_id is always a response; rows that repeat a
page_id are records of their own; of equal payloads those with the largest page_id are
responses; an empty table makes an archive without records; columns beyond page_id, url and
html are not archived.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, Not,
    StringStartsWith, WriterCommitMessage,
)

from tellerlake.llm.shared import new_path, written

MIN_REVISIT_BYTES = 1000
MANIFEST = "_manifest.json"
FILE_BYTES, PARTITION_BYTES = 256 << 20, 64 << 20

# Header names and profile of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Column of the source and the header it comes from.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "WARC-Payload-Length",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS if c != "payload_bytes") + ", payload_bytes long, payload binary"
ARROW = pa.schema([(c, pa.string()) for c in HEADERS if c != "payload_bytes"] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])


class _File(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class _Committed(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


def _opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def encode_record(values: dict) -> bytes:
    """One record as a gzip member whose extra field holds the member's length."""
    payload = values.get("payload") or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload
    lines = [VERSION]
    for column, header in HEADERS.items():
        if values.get(column) is not None:
            lines.append(f"{header}: {values[column]}".encode())
    if values["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}".encode())
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    record = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    extra = b"sl" + (4).to_bytes(2, "little") + (20 + len(body) + 8).to_bytes(4, "little")
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra
    return head + body + zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")


def parse_headers(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def _columns(headers: dict[str, str]) -> dict:
    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] else None
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    return row


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """The block without HTTP headers, if it is an HTTP message."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _own_records(f, wanted, payloads: bool) -> Iterator[dict]:
    """Records of an archive whose members hold their length; `f` is seekable."""
    while head := f.read(20):
        left = int.from_bytes(head[16:20], "little") - 20
        inflate, plain = zlib.decompressobj(-15), b""
        while b"\r\n\r\n" not in plain and left > 8:
            part = f.read(min(left, 2048))
            left -= len(part)
            plain += inflate.decompress(part)
        top, _, rest = plain.partition(b"\r\n\r\n")
        headers = parse_headers(top)
        row = _columns(headers)
        if not wanted(row) or not payloads:
            f.seek(left, 1)
            if wanted(row):
                yield row
            continue
        tail = f.read(left)
        rest += inflate.decompress(tail) + inflate.flush()
        row["payload"] = _payload(headers, rest[:int(headers["content-length"])])
        yield row


def _any_records(stream, wanted, payloads: bool) -> Iterator[dict]:
    """Records of any archive, from start to end."""
    while line := stream.readline():
        if not line.strip():
            continue
        head = [line.strip()]
        while (line := stream.readline()).strip():
            head.append(line.strip())
        headers = parse_headers(b"\r\n".join(head))
        row, size = _columns(headers), int(headers.get("content-length", 0))
        if wanted(row) and payloads:
            row["payload"] = _payload(headers, stream.read(size))
        else:
            while size > 0:
                size -= len(stream.read(min(size, 1 << 20))) or size
        if wanted(row):
            yield row


def _holds(filters: list) -> callable:
    """A test of header columns for the pushed filters; nulls pass none, as in SQL, but Not(<=>)."""
    def one(f, row):
        if isinstance(f, Not):
            return row[f.child.attribute[0]] != f.child.value
        value = row[f.attribute[0]]
        if value is None:
            return False
        if isinstance(f, EqualTo):
            return value == f.value
        if isinstance(f, In):
            return value in f.value
        return isinstance(f, IsNotNull) or value.startswith(f.value)

    return lambda row: all(one(f, row) for f in filters)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() == "true"
        self.target = int(options.get("partitionbytes", PARTITION_BYTES))
        self.filters = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, Not):
                if isinstance(f.child, EqualNullSafe) and f.child.attribute[0] in HEADERS:
                    self.filters.append(f)
                else:
                    yield f
                continue
            kinds = (EqualTo, In, IsNotNull) if f.attribute == ("payload_bytes",) else (EqualTo, In, IsNotNull, StringStartsWith)
            if isinstance(f, kinds) and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = _opened(self.path)
        manifest = fs.get_file_info(f"{root}/{MANIFEST}")
        if manifest.type == pa.fs.FileType.File:
            with fs.open_input_stream(manifest.path) as f:
                files = [(f"{root}/{name}", size) for name, size in json.loads(f.read())]
        else:
            found = fs.get_file_info(pa.fs.FileSelector(root, recursive=True))
            files = [(x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz"))]
        parts, size = [[]], 0
        for name, bytes_ in sorted(files):
            if parts[-1] and size + bytes_ > self.target:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size += bytes_
        return [_File(p) for p in parts]

    def read(self, partition):
        fs, _ = _opened(self.path)
        wanted = _holds(self.filters)
        for name in partition.files:
            with fs.open_input_file(name) as f:
                start = f.read(16)
                f.seek(0)
                if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
                    rows = _own_records(f, wanted, self.payloads)
                elif start[:2] == b"\x1f\x8b":
                    rows = _any_records(io.BufferedReader(gzip.GzipFile(fileobj=f)), wanted, self.payloads)
                else:
                    rows = _any_records(io.BufferedReader(f), wanted, self.payloads)
                yield from _batched(rows)


def _batched(rows: Iterator[dict], most: int = 1000, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append({"payload": None, **row})
        size += len(row.get("payload") or b"")
        if len(part) >= most or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(part, schema=ARROW)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_pylist(part, schema=ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.most = options["path"], int(options.get("filebytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator):
        fs, root = _opened(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for values in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                if values.get("payload_digest"):
                    values["payload_digest"] = f"sha1:{values['payload_digest']}"
                size += out.write(encode_record(values))
                if size >= self.most:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Committed(files)

    def commit(self, messages):
        fs, root = _opened(self.path)
        fs.create_dir(root, recursive=True)
        names = [f for m in messages if m for f in m.files]
        manifest = fs.get_file_info(f"{root}/{MANIFEST}")
        if not self.overwrite and manifest.type == pa.fs.FileType.File:
            with fs.open_input_stream(manifest.path) as f:
                names += [tuple(x) for x in json.loads(f.read())]
        with fs.open_output_stream(f"{root}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, root = _opened(self.path)
        for name in [f[0] for m in messages if m for f in m.files]:
            fs.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame) -> DataFrame:
    """Records for pages (page_id, url, html): responses, and revisits of equal payloads.

    Only digests and ids are shuffled to find equal payloads. The table of repeated
    digests is written, so the planner knows its size: broadcast below the session's
    threshold, else a sorted join, where adaptive execution splits a hot digest.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    large = rows.where(F.col("size") >= MIN_REVISIT_BYTES)
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    repeated = written(repeated.where("n > 1").select(F.col("digest").alias("r_digest"), "original"), "warc-repeated")
    met = rows.join(repeated, (F.col("digest") == F.col("r_digest")) & (F.col("size") >= MIN_REVISIT_BYTES), "left")
    revisit = F.coalesce(F.col("page_id") < F.col("original"), F.lit(False))

    def urn(column):
        return F.concat(F.lit("<urn:page:"), column.cast("string"), F.lit(">"))

    return met.select(
        F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _as_uri(F.col("url")).alias("target_uri"),
        F.lit("2000-01-01T00:00:00Z").alias("date"),
        F.when(revisit, urn(F.col("original"))).alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.when(~revisit, F.col("html").cast("binary")).alias("payload"),
        F.col("size").alias("payload_bytes"),
    )


def _as_uri(url):
    """The url, percent-encoded as a whole if it has what may not stand in a header line."""
    codes = F.regexp_replace(F.hex(F.encode(url, "UTF-8")), "(..)", "%$1")
    return F.when(url.rlike(r"^[\x21-\x7e]+\z"), url).otherwise(codes)


def archive(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record read back; sizes and digests of responses are of what was read.

    Responses are read with their payloads, all other records by their headers only; both by
    a record type that the reader gets.
    """
    def number(column):
        return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    def rows(read, size, digest):
        return read.select(
            number(F.col("record_id")).alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"),
            "record_type", number(F.col("refers_to")).alias("refers_to"),
        )

    responses = read_archive(spark, path).where("record_type = 'response'")
    others = read_archive(spark, path, payload=False).where("not record_type <=> 'response'")
    return rows(responses, F.octet_length("payload").cast("long"), F.sha1("payload")).unionAll(
        rows(others, F.col("payload_bytes"), F.col("payload_digest"))
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    path = new_path(pages.sparkSession, "warc")
    archive(pages, path)
    return archived_pages(pages.sparkSession, path)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d),
r AS (SELECT *, coalesce(payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < original, false) AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN original END AS refers_to FROM r
"""
