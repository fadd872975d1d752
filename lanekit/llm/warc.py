"""WARC archives with the index first.

Writing produces, next to the archives, an index row per record: file,
offset, length, url and payload digest. Reading starts from index rows, never
from the archives: the selected ones are sorted by place, neighbouring byte
ranges are coalesced into one read each, and the records are cut out of it.
Each record is a gzip member of its own, so a range stands alone.

Which record of equal payloads holds the payload is decided on digests alone,
before any page moves. Archives lie below the folder all executors share and
are named per task attempt; a lost task leaves a file that no index row names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanekit.llm.common import stage
from lanekit.sources.scratch import scratch_path

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 1 << 30
TASK_BYTES = 16 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "2020-01-01T00:00:00Z"

#: Version line and profile of the WARC format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id bigint, file string, offset bigint, length bigint, url string, payload_digest string, "
         "record_type string")
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a Hadoop-style folder name."""
    scheme, _, rest = uri.partition(":")
    if not rest or "/" in scheme:
        return pyarrow.fs.LocalFileSystem(), uri
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


# ------------------------------------------------------------------ records

def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One WARC record; a revisit of page ``first`` unless that is null."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if first is not None else http + payload
    head = [VERSION, b"WARC-Type: " + (b"response" if first is None else b"revisit"),
            b"WARC-Record-ID: " + _urn(page_id), b"WARC-Date: " + DATE.encode()]
    if url:
        head.append(b"WARC-Target-URI: " + " ".join(url.split()).encode())
    head.append(b"WARC-Payload-Digest: sha1:" + digest(payload).encode())
    if first is not None:
        head += [b"WARC-Profile: " + SAME_PAYLOAD, b"WARC-Refers-To: " + _urn(first)]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[bytes, bytes]:
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(b":") for x in lines)}


def _page(urn: bytes | None) -> int | None:
    number = (urn or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def parse(raw: bytes) -> tuple[dict[bytes, bytes], dict[bytes, bytes], bytes]:
    """(record header, HTTP header, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record: {raw[:40]!r}")
    fields = _fields(lines)
    block = rest[:int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http.split(b"\r\n")[1:]), payload


# ------------------------------------------------------------------ writing

def firsts(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(sha, first): payloads that several pages share, with the smallest page
    id that has them."""
    return (pages.filter(F.octet_length(_payload()) >= min_bytes)
            .groupBy(F.sha1(_payload()).alias("sha")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
            .filter("n > 1").select("sha", "first"))


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES,
          archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) below
    ``folder`` and returns the index, itself written to the shared folder.

    Of rows with equal payloads of ``min_bytes`` or more the one with the
    smallest id is the response, the others refer to it. Rows that repeat that
    id are all responses; rows without an id are revisits if any row with an
    id has the payload. Null html is the empty payload.
    """
    shared = stage(firsts(pages, min_bytes), "warc-firsts").withColumnRenamed("sha", "__sha")
    rows = (pages.select("page_id", "url", _payload().alias("payload"), F.sha1(_payload()).alias("sha"))
            .join(shared, F.col("sha") == F.col("__sha"), "left")
            .select("page_id", "url", "payload",
                    F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for page_id, url, payload, first in zip(*(batch.column(i) for i in range(4))):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    page_id, url, payload, first = page_id.as_py(), url.as_py(), payload.as_py(), first.as_py()
                    member = gzip.compress(record(page_id, url, payload, first), 5, mtime=0)
                    out.write(member)
                    index.append((page_id, f"{folder}/{name}", at, len(member), url, digest(payload),
                                  "response" if first is None else "revisit"))
                    at += len(member)
                if index:
                    yield _table(index, INDEX)
        finally:
            if out is not None:
                out.close()

    return stage(rows.mapInArrow(run, INDEX), "warc-index")


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)],
                                      [n for n, _ in fields])


# ------------------------------------------------------------------ reading

def read(index: DataFrame, payload: bool = False, read_bytes: int = READ_BYTES,
         gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records that the rows of ``index`` (a selection of a written index)
    point to: page_id, payload_bytes, payload_digest, record_type, refers_to
    and, if asked for, the payload (null for revisits). A response whose
    payload does not have the digest of its header, or an index row that
    points to no record, is an error."""
    schema = RECORDS + (", payload binary" if payload else "")
    # by the records' bytes: the index itself is far too small to tell the tasks' work
    stored = index.agg(F.sum("length")).first()[0] or 0
    places = (index.select("file", "offset", "length").repartitionByRange(-(-stored // TASK_BYTES) or 1, "file", "offset")
              .sortWithinPartitions("file", "offset"))

    def ranges(batches):
        """(file, first, after last, [(offset, length)]) of coalesced reads."""
        held = None
        for batch in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if (held and held[0] == file and offset - held[2] <= gap_bytes
                        and offset + length - held[1] <= read_bytes):
                    held[2] = max(held[2], offset + length)
                    held[3].append((offset, length))
                else:
                    if held:
                        yield held
                    held = [file, offset, offset + length, [(offset, length)]]
        if held:
            yield held

    def run(batches):
        source, opened = None, None
        for file, begin, end, places in ranges(batches):
            if file != opened:
                fs, path = filesystem(file)
                source, opened = fs.open_input_file(path), file
            data = source.read_at(end - begin, begin)
            rows = []
            for offset, length in places:
                fields, http, body = parse(gzip.decompress(data[offset - begin:offset - begin + length]))
                kind = fields[b"warc-type"].decode()
                named = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
                if kind == "response" and digest(body) != named:
                    raise ValueError(f"{file} at {offset}: the payload does not have its digest")
                row = (_page(fields[b"warc-record-id"]), int(http[b"content-length"]), named, kind,
                       _page(fields.get(b"warc-refers-to")))
                rows.append(row + ((body if kind == "response" else None,) if payload else ()))
            yield _table(rows, schema)

    return places.mapInArrow(run, schema)


def archived(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes all ``pages`` and reads every record back through the index: a
    row per row of ``pages``. An empty table writes no archive and gives no
    rows."""
    return read(write(pages, scratch_path(spark, "llm-warc"), min_bytes))
