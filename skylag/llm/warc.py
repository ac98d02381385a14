"""WARC archives: written by tasks, read by byte ranges.

Writing. Every page is one record, a gzip member of its own. Of pages with equal
content of at least ``REVISIT_BYTES`` bytes, that with the smallest key is a response,
the others are revisits of it: they hold its digest and the HTTP header, no content.
Digests meet, not pages: the smallest key of each repeated digest is joined to the
pages where they lie. Each task writes its own files; only files of tasks that ended
well are in the table returned, so what a lost executor leaves behind is not read.

Reading. A file is cut into ranges of bytes, and tasks read ranges. A task looks for
the magic of a gzip member; a place that has it is a candidate, and a record only if
it inflates to a whole member with the header fields of a record. A task owns the
records that start in its range and reads the last one past the range's end. After a
record it goes on behind it, so an archive stored inside a record is not taken for
records of its own, unless a range starts inside that record: ``outermost`` drops
these, by how far the ranges before reach.

Defined cases: a null content is an empty one; equal rows of the smallest key are all
responses, with one record id; rows without a key come after all keys, and are all
responses where none has one; a null address has no address field, and
characters that cannot stand in a header are percent-encoded; a member that is cut
off or damaged is no record; an empty table gives no file. Columns other than key,
address and content are not stored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.llm.common import materialise, table
from skylag.session import work_path

REVISIT_BYTES = 100
RANGE_BYTES = 16 << 20
FILE_BYTES = 1 << 30
# Bytes of content in one batch that goes back to Spark.
BATCH_BYTES = 8 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 16

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
GZIP = 31

FILES = "path string, records long, size long"
RECORDS = (
    "path string, start long, offset long, length long, type string, record_id string, uri string, date string,"
    " refers_to string, digest string, content_bytes long, content binary"
)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address as Spark gives it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file://"):
        return fs.LocalFileSystem(), unquote(uri.removeprefix("file://")) if "%" in uri else uri.removeprefix("file://")
    return fs.FileSystem.from_uri(uri)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    parts = (b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n")
    return b"".join([*map(packer.compress, parts), packer.flush()])


def _header_value(text: str) -> str:
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~{}|^`\"<>\\")


def record_id(key: object, digest: str) -> str:
    name = "null" if key is None else quote(str(key), safe="")
    return f"<urn:x-page:{name}:{digest[:32]}>"


def _page(key: object, uri: str | None, content: bytes, size: int, digest: str, first: object, again: bool) -> bytes:
    kind = "revisit" if again else "response"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key, digest)), ("WARC-Date", DATE)]
    if uri is not None:
        fields.append(("WARC-Target-URI", _header_value(uri)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if again:
        fields += [("WARC-Refers-To", record_id(first, digest)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    return _record(fields, http.encode() + (b"" if again else content))


def _files_of(folder: str, file_bytes: int):
    """Function that writes the rows of a task and gives one row for each file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, path, done, number = TaskContext.get(), None, "", [0, 0], 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [done[0]], "size": [done[1]]}, pa.schema([("path", pa.string()), ("records", pa.int64()), ("size", pa.int64())]))

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    path, done, number = f"{folder}/{name}", [0, 0], number + 1
                    system, place = _opened(path)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(place, compression=None)
                    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
                    done[1] += out.write(_record(about, b"format: WARC File Format 1.1\r\n"))
                done[0] += 1
                done[1] += out.write(_page(*row))
                if done[1] >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return write


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", content: str = "html", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write every page as a record below ``folder``; (path, records, size) of the files."""
    rows = pages.select(F.col(key).alias("key"), F.col(uri).cast("string").alias("uri"), F.coalesce(F.col(content).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("key", "uri", F.col("text").cast("binary").alias("content"), F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("digest"))
    long = rows.where(F.col("size") >= REVISIT_BYTES).select("digest", "key")
    firsts = long.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    # Written, so that its size is known: a small table goes to the pages, not they to it.
    known = rows.join(materialise(firsts.select("digest", "first"), "warc-firsts"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    body = F.when(~again, F.col("content")).otherwise(F.lit(b""))
    known = known.select("key", "uri", body.alias("content"), "size", "digest", "first", again.alias("again"))
    return materialise(known.mapInArrow(_files_of(folder, file_bytes), FILES), "warc-files")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size) of the files below ``folder``, also those of other writers."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path", F.col("length").alias("size"))


_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$", re.M)


def _fields(head: bytes) -> dict[str, str]:
    return {name.decode().lower(): value.decode("utf-8", "replace") for name, value in _FIELD.findall(head.replace(b"\r\n", b"\n"))}


class _Range:
    """Bytes of a file from a place on, read as they are asked for."""

    def __init__(self, stream: pa.NativeFile, start: int, stop: int):
        self.stream, self.start = stream, start
        stream.seek(start)
        self.data = stream.read(stop - start + len(MAGIC) - 1)

    def find(self, at: int) -> int:
        place = self.data.find(MAGIC, at - self.start)
        return -1 if place < 0 else self.start + place

    def chunks(self, at: int) -> Iterator[bytes]:
        """What follows ``at``: a little, then the rest, to the end of the file."""
        place, step = at - self.start, 1024
        while place < len(self.data):
            yield self.data[place : place + step]
            place, step = place + step, READ_BYTES
        place = self.start + len(self.data)
        while True:
            self.stream.seek(place)
            more = self.stream.read(READ_BYTES)
            if not more:
                return
            yield more
            place += len(more)

    def record(self, at: int) -> tuple[int, dict[str, str], bytes] | None:
        """(length in the file, header fields, block) of the member at ``at``, if it is a record."""
        unpacker, parts, read, size, checked = zlib.decompressobj(GZIP), [], 0, 0, False
        try:
            for chunk in self.chunks(at):
                parts.append(unpacker.decompress(chunk))
                read, size = read + len(chunk), size + len(parts[-1])
                if not checked and (size >= 7 or unpacker.eof):
                    checked = True
                    if not b"".join(parts).startswith(b"WARC/1."):
                        return None
                if unpacker.eof:
                    break
        except zlib.error:
            return None
        if not unpacker.eof:
            return None
        whole = b"".join(parts)
        end = whole.find(b"\r\n\r\n", 0, HEADER_BYTES)
        fields = _fields(whole[:end]) if end >= 0 else {}
        wanted = fields.get("content-length", "")
        if not (wanted.isdigit() and fields.get("warc-type") and fields.get("warc-record-id")):
            return None
        block = whole[end + 4 : end + 4 + int(wanted)]
        return (read - len(unpacker.unused_data), fields, block) if len(block) == int(wanted) else None


def records_of(stream: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of the records that start in [start, stop)."""
    part, at = _Range(stream, start, stop), start
    while True:
        at = part.find(at)
        if not start <= at < stop:
            return
        found = part.record(at)
        if found is None:
            at += 1
        else:
            yield at, *found
            at += found[0]


def _content(fields: dict[str, str], block: bytes) -> tuple[int, bytes | None]:
    """Size and bytes of what a record's HTTP message holds, or of its block."""
    if not fields.get("content-type", "").startswith("application/http"):
        return len(block), block
    head, _, body = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "revisit":
        size = _fields(head).get("content-length", "")
        return int(size) if size.isdigit() else 0, None
    return len(body), body


_KEPT = ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-refers-to", "warc-payload-digest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), *[pa.int64()] * 3, *[pa.string()] * 6, pa.int64(), pa.binary()]
    names = [column.split()[0] for column in RECORDS.split(", ")]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema=schema)

    rows, held = [], 0
    for batch in batches:
        for path, start, stop in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            system, place = _opened(path)
            with system.open_input_file(place) as stream:
                for offset, length, fields, block in records_of(stream, start, stop):
                    size, body = _content(fields, block)
                    rows.append((path, start, offset, length, *map(fields.get, _KEPT), size, body))
                    held += len(block) + 500
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
    if rows:
        yield batch_of(rows)


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of ``files`` (path, size), read by ranges; ``start`` is that of the range."""
    count = files.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0] or 1
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.where("size > 0").select("path", "size", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("stop"))
    return ranges.repartition(int(count)).mapInArrow(_read, RECORDS)


def outermost(records: DataFrame) -> DataFrame:
    """``records`` without those that lie inside another record of their file.

    Such records come only from a range that starts inside the other one. Each
    range is one row here, so a file of any size may be read; ``records`` is read twice.
    """
    ranges = records.groupBy("path", "start").agg(F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("end"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("reach", F.max("end").over(before)).where("first < reach").select("path", "start", "reach")
    return records.join(inside, ["path", "start"], "left").where("reach is null or offset >= reach").drop("reach")


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits, revisits with the content of the response they name."""
    held = records.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("content").alias("_held")).dropDuplicates(["refers_to"])
    pages = records.where("type in ('response', 'revisit')").join(held, "refers_to", "left")
    return pages.withColumn("content", F.coalesce("content", "_held")).drop("_held").select(*records.columns)


def _key(urn: str):
    return F.regexp_extract(urn, r"^<urn:x-page:(-?[0-9]+):", 1).try_cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = read_archives(write_archives(pages, work_path(spark, "warc")))
    digest = F.when(F.col("type") == "response", F.sha2("content", 256)).otherwise(F.substring_index("digest", ":", -1))
    rows = records.where("type in ('response', 'revisit')").select(
        "path", "start", "offset", "length", _key("record_id").alias("page_id"), F.col("content_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"), F.col("type").alias("record_type"), _key("refers_to").alias("refers_to"),
    )
    rows = outermost(materialise(rows, "warc-rows"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH held AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM held WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM held LEFT JOIN firsts USING (payload_digest)
"""
