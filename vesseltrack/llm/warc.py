"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: each task streams its rows into WARC 1.1 files (a new one after
``rollBytes``, so a file, the unit of reading, stays bounded). A payload is the
body of an HTTP response record, gzip-encoded where that is shorter; a revisit
has headers only. The driver lists the files of successful tasks in
``_manifest`` at commit; readers take the listed ones, so files of failed or
repeated tasks are never read.

Reading: one partition per file. Headers are parsed first; predicates on
header columns are pushed into the reader (``pushFilters``) and decided on the
headers alone; the block is read and decoded only when the record passes and
the schema asks for ``payload``, else it is skipped by a seek (a gzipped
``.warc.gz`` is inflated, but its unwanted blocks are not kept or decoded).

Paths go through ``pyarrow.fs``: local files, HDFS and object stores alike.

A record that the end of its file cuts off (in its headers, in its block, or in
the compressed stream) is an error, whether its block is read or skipped. With
the option ``truncated`` = ``mark`` it comes as a row of record type ``truncated``
without a payload instead (see ``truncated_records``), with ``skip`` it is left out.
Bodies sent in chunks are put together.

Edge cases: null or empty payloads are records with an empty body; null ids,
uris and digests leave the header out and read back as null; line breaks in a
uri are percent-encoded; an empty table makes an archive without records.
"""

from __future__ import annotations

import gzip
import json
import sys
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
    StringStartsWith, WriterCommitMessage,
)

from vesseltrack.session import scratch_path

# Header names and the profile of the WARC 1.1 format.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
           "content_length": "Content-Length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NUMBERS = ("payload_length", "content_length")
SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_length bigint, content_length bigint, payload binary")
MIN_REVISIT_BYTES = 100
ROLL_BYTES = 256 << 20
BATCH_BYTES = 4 << 20


def filesystem(path: str):
    """(file system, path in it) of a uri or local path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _header_text(value) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def record_bytes(row: dict, date: str) -> bytes:
    """One record: headers, block, two line ends."""
    head = {k: row[k] for k in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_length")
            if row.get(k) is not None}
    lines = [f"{HEADERS[k]}: {_header_text(v)}" for k, v in head.items()]
    lines.append(f"{HEADERS['date']}: {_header_text(row.get('date') or date)}")
    block = b""
    if row.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    else:
        body = row.get("payload") or b""
        packed = gzip.compress(body, 1, mtime=0)
        http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        if len(packed) < len(body):
            http, body = http + "Content-Encoding: gzip\r\n", packed
        block = f"{http}Content-Length: {len(body)}\r\n\r\n".encode() + body
        lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """A body sent in chunks (hexadecimal length, line end, bytes, line end; a chunk of no bytes ends it)."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body without a last chunk")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if at > len(body):
            raise ValueError("chunked body cut off")
        out.append(body[end + 2:at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response block, its transfer and content encodings undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {n.strip().lower(): v.strip().lower() for n, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").endswith(b"chunked"):
        body = unchunked(body)
    return zlib.decompress(body, 47) if fields.get(b"content-encoding") in (b"gzip", b"x-gzip", b"deflate") else body


class Truncated(Exception):
    """A record that the end of its file cuts off."""


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class ArchiveFile(InputPartition):
    path: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.roll, self.overwrite = options["path"].rstrip("/"), int(options.get("rollBytes", ROLL_BYTES)), overwrite
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator):
        where, base = filesystem(self.path)
        where.create_dir(base, recursive=True)
        files, out = [], None
        for b in iterator:
            columns = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                if out is None or out.tell() >= self.roll:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc")
                    out = where.open_output_stream(f"{base}/{files[-1]}", buffer_size=1 << 20)
                out.write(record_bytes({n: c[i].as_py() for n, c in columns.items()}, self.date))
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        where, base = filesystem(self.path)
        where.create_dir(base, recursive=True)
        listed = [] if self.overwrite else manifest(self.path) or []
        with where.open_output_stream(f"{base}/_manifest") as out:
            out.write(json.dumps(listed + [f for m in messages if m for f in m.files]).encode())

    def abort(self, messages):
        where, base = filesystem(self.path)
        for f in (f for m in messages if m for f in m.files):
            where.delete_file(f"{base}/{f}")


def manifest(path: str) -> list | None:
    """The committed files of an archive folder; None where there is no list."""
    where, base = filesystem(path)
    from pyarrow import fs
    if where.get_file_info(f"{base}/_manifest").type == fs.FileType.NotFound:
        return None
    with where.open_input_stream(f"{base}/_manifest") as f:
        return json.loads(f.read())


_TESTS = {EqualTo: lambda a, f: a is not None and a == f.value, EqualNullSafe: lambda a, f: a == f.value,
          GreaterThan: lambda a, f: a is not None and a > f.value, GreaterThanOrEqual: lambda a, f: a is not None and a >= f.value,
          LessThan: lambda a, f: a is not None and a < f.value, LessThanOrEqual: lambda a, f: a is not None and a <= f.value,
          In: lambda a, f: a is not None and a in f.value, IsNull: lambda a, f: a is None, IsNotNull: lambda a, f: a is not None,
          StringStartsWith: lambda a, f: a is not None and a.startswith(f.value),
          StringEndsWith: lambda a, f: a is not None and a.endswith(f.value),
          StringContains: lambda a, f: a is not None and f.value in a}


def decided_by_headers(f) -> bool:
    inner = f.child if isinstance(f, Not) else f
    # a negated null comparison is null, not true: only null tests are negated here
    if isinstance(f, Not) and not isinstance(inner, (IsNull, IsNotNull, EqualNullSafe)):
        return False
    return type(inner) in _TESTS and len(inner.attribute) == 1 and inner.attribute[0] in HEADERS


def passes(row: dict, f) -> bool:
    if isinstance(f, Not):
        return not passes(row, f.child)
    return _TESTS[type(f)](row.get(f.attribute[0]), f)


def parse_headers(lines: list[bytes]) -> dict:
    """Header columns of a record; names without regard to case, folded lines joined."""
    by_name, last = {}, None
    for line in lines:
        if line[:1] in b" \t" and last:
            by_name[last] += b" " + line.strip()
            continue
        name, _, value = line.partition(b":")
        last = name.strip().lower()
        by_name[last] = value.strip()
    row = {}
    for column, name in HEADERS.items():
        value = by_name.get(name.lower().encode())
        row[column] = None if value is None else int(value) if column in NUMBERS else value.decode("utf-8", "surrogatepass")
    return row


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.path, self.filters = schema, options["path"].rstrip("/"), []
        self.truncated = options.get("truncated", "fail")
        if self.truncated not in ("fail", "mark", "skip"):
            raise ValueError(f"truncated: fail, mark or skip, not {self.truncated}")

    def pushFilters(self, filters):
        for f in filters:
            if decided_by_headers(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        where, base = filesystem(self.path)
        from pyarrow import fs
        listed = manifest(self.path)
        if listed is not None:
            return [ArchiveFile(f"{base}/{f}") for f in listed] or [ArchiveFile("")]
        info = where.get_file_info(base)
        found = [info] if info.type == fs.FileType.File else where.get_file_info(fs.FileSelector(base, recursive=True))
        names = sorted(i.path for i in found if i.type == fs.FileType.File and i.path.endswith((".warc", ".warc.gz")))
        return [ArchiveFile(n) for n in names] or [ArchiveFile("")]

    def read(self, partition):
        names = [f.name for f in self.schema.fields]
        kinds = {"payload": pa.binary(), **{n: pa.int64() for n in NUMBERS}}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        rows, size = [], 0
        for row in self.records(partition.path) if partition.path else ():
            rows.append(row)
            size += 200 + len(row.get("payload") or b"")
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def records(self, path: str):
        """Rows of one file; a record that its end cuts off is dealt with as the option says."""
        row: dict = {}
        try:
            for row in self._whole_records(path):
                yield row
        except Truncated as e:
            if self.truncated == "fail":
                raise ValueError(f"{path}: {e}") from e
            mark = {**dict.fromkeys(HEADERS), "record_type": "truncated", "target_uri": path}
            if self.truncated == "mark" and all(passes(mark, f) for f in self.filters):
                yield mark

    def _whole_records(self, path: str):
        where, _ = filesystem(self.path)
        wanted = any(f.name == "payload" for f in self.schema.fields)
        packed = path.endswith(".gz")
        if packed:
            source, size = gzip.GzipFile(fileobj=where.open_input_file(path), mode="rb"), None
        else:
            import io
            source, size = io.BufferedReader(where.open_input_file(path), 1 << 18), where.get_file_info(path).size

        def skipped(length: int) -> None:
            to = source.tell() + length
            if source.seek(length, 1) < to or size is not None and to > size:  # a seek beyond the end is no error by itself
                raise Truncated(f"a block of {length} bytes is cut off")

        with source:
            try:
                while True:
                    line = source.readline()
                    while line in (b"\r\n", b"\n"):
                        line = source.readline()
                    if not line:
                        return
                    if not line.startswith(b"WARC/"):
                        if b"WARC/".startswith(line):
                            raise Truncated("a record's first line is cut off")
                        raise ValueError(f"{path}: no record at {source.tell() - len(line)}")
                    lines = []
                    while (line := source.readline()) not in (b"\r\n", b"\n"):
                        if not line.endswith(b"\n"):
                            raise Truncated("a record's headers are cut off")
                        lines.append(line.rstrip(b"\r\n"))
                    row = parse_headers(lines)
                    length = row["content_length"] or 0
                    if not all(passes(row, f) for f in self.filters):
                        skipped(length)
                        continue
                    if wanted and row["record_type"] != "revisit":
                        block = source.read(length)
                        if len(block) < length:
                            raise Truncated(f"{len(block)} of a block's {length} bytes")
                        row["payload"] = payload_of(block)
                    else:
                        skipped(length)
                    yield row
            except EOFError as e:  # the compressed stream ends early
                raise Truncated(str(e)) from e


class WarcSource(DataSource):
    """Options: path; for writing rollBytes and date; for reading truncated (fail, mark or skip)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with predicate pushdown into Python sources on."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no import of this package
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_rows(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Records of pages (page_id, url, html), equal payloads of ``min_bytes`` or more stored once.

    The smallest page_id with a payload is its response, the others revisit it
    (rows with that smallest id, if repeated, are all responses; null ids come
    last). Digests are reduced to their first id map-side; payloads move once,
    in the join with that list, which Spark splits at hot digests; small
    payloads join nothing and are spread by id.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumns(
        {"payload_length": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    big = F.col("payload_length") >= min_bytes
    rows = rows.withColumn("key", F.when(big, F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url").cast("string"))))
    first = rows.where(big).groupBy("key").agg(F.min("page_id").alias("first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return rows.join(first, "key", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_archive(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    archive_rows(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, columns: list[str] | None = None, truncated: str = "fail") -> DataFrame:
    """Records of an archive; only the named columns (without ``payload`` no block is read)."""
    register(spark)
    fields = [f for f in SCHEMA.split(", ") if columns is None or f.split()[0] in columns]
    return spark.read.format("warc").schema(", ".join(fields)).option("truncated", truncated).load(path)


def truncated_records(spark: SparkSession, path: str) -> DataFrame:
    """target_uri: the files of an archive that end inside a record, by their headers and lengths alone."""
    return read_archive(spark, path, ["record_type", "target_uri"], "mark").where("record_type = 'truncated'").select("target_uri")


def page_number(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archive and read it back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, whose length and digest are computed
    anew; revisits by their headers only.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(pages, path)
    full = read_archive(spark, path, ["record_type", "record_id", "payload"]).where("record_type = 'response'").select(
        page_number(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    again = read_archive(spark, path, ["record_type", "record_id", "refers_to", "payload_digest", "payload_length"]).where(
        "record_type = 'revisit'").select(
        page_number(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page_number(F.col("refers_to")).alias("refers_to"))
    return full.unionByName(again)


ORACLE_ROUND_TRIP = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d FROM p),
r AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM r
"""
