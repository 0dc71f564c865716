"""WARC archives without repeated payloads: write, resolve revisits, write anew, read back.

Archives hold one gzip member per record. A first set takes every page as a response. From it only
headers travel: they are shuffled by payload digest, the first record of each digest is the
original, and every later one is joined to it. Each archive is then copied by the task that gets
its headers in file order: originals keep their payload, the others become revisit records, and
all get fresh headers. A revisit's payload is found at the record it refers to.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import join_spread, staged, text_batches
from parcelflow.llm.tokens import _a_task_each, _open
from parcelflow.session import new_scratch

#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 0
#: Bytes read or packed at once.
CHUNK = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
RESPONSE, REVISIT = "response", "revisit"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_SPACE = uuid.UUID("6f1c2f0e-6f63-4f0e-9f63-5d1b2c3a4e5f")

FILES = "part int, file string, records long"
HEADERS = "part int, at long, page_id {id}, record_id string, uri string, bytes long, digest string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    # A line end in a value would begin a new header.
    lines = [f"{name}: {' '.join(value.split())}".encode() for name, value in headers]
    head = b"\r\n".join([VERSION, *lines, b"Content-Length: %d" % len(block), b"", b""])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def records(source: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with names in small letters, block) of each record; one record is held at a time."""
    rest = b""
    while rest or (rest := source.read(CHUNK)):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest and not (rest := source.read(CHUNK)):
                raise EOFError("an archive ends inside a record")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        whole = b"".join(parts)
        end = whole.index(b"\r\n\r\n")
        first, *lines = whole[:end].split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        for line in lines:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        begin = end + 4
        yield headers, whole[begin : begin + int(headers["content-length"])]


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers."""
    return block[block.index(b"\r\n\r\n") + 4 :]


def _headers(kind: str, record_id: str, uri: str | None, page: str, digest: str, more=()) -> list[tuple[str, str]]:
    known = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    # A missing or empty address is no header.
    known += [("WARC-Target-URI", uri)] if uri and uri.strip() else []
    known += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    return [*known, ("WARC-Page-ID", page), *more]


def _path(folder: str, name: str):
    files, root = _open(folder)
    return files, f"{root}/{name}"


def write_pages(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> tuple[DataFrame, DataFrame]:
    """(files, headers): an archive per task with a response for every row, and a header row per record.

    Payload: the html's UTF-8 bytes, none for null. Files are named after the attempt that wrote
    them; only those of the tables given back are ever read.
    """
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("uri"), F.col(f"`{html_col}`").alias("html"))
    kind = slim.schema["page_id"].dataType.simpleString()
    schema = HEADERS.format(id=kind) + ", file string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, name, at, out = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch, payloads in text_batches(batches, "html"):
                columns = ([], [], [])
                for page, uri, payload in zip(batch.column("page_id").to_pylist(), batch.column("uri").to_pylist(), payloads, strict=True):
                    payload = payload or b""
                    if out is None:
                        files, path = _path(folder, name)
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        out = files.open_output_stream(path)
                    digest, row = payload_digest(payload), at + len(columns[0])
                    # Deterministic, so a repeated attempt writes the same records.
                    record_id = f"urn:uuid:{uuid.uuid5(_SPACE, f'{part}/{row}/{page}/{digest}')}"
                    out.write(record(_headers(RESPONSE, record_id, uri, "" if page is None else str(page), digest), _HTTP % len(payload) + payload))
                    for column, value in zip(columns, (record_id, len(payload), digest), strict=True):
                        column.append(value)
                n = len(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), batch.column("page_id"), pa.array(columns[0], pa.string()),
                        batch.column("uri"), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array([name] * n, pa.string()),
                    ],
                    ["part", "at", "page_id", "record_id", "uri", "bytes", "digest", "file"],
                )
                at += n
        finally:
            if out is not None:
                out.close()

    headers = staged(slim.mapInArrow(run, schema), "warc-headers")
    files = staged(headers.groupBy("part", "file").agg(F.count(F.lit(1)).alias("records")), "warc-files")
    return files, headers.drop("file")


def resolve(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """headers with (original_id, original_uri), null for responses.

    Of records with equal payloads of at least min_bytes bytes the original is the one with the smallest
    page_id, a missing one last; of those with the same page_id the one that was written first.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "part", "at", "record_id", "uri")
    first = headers.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min(order).alias("first"))
    original = first.select("digest", F.col("first.record_id").alias("original_id"), F.col("first.uri").alias("original_uri"))
    joined = join_spread(headers.where(F.col("bytes") >= min_bytes), original, "digest")
    later = F.col("record_id") != F.col("original_id")
    joined = joined.select(
        *headers.columns, F.when(later, F.col("original_id")).alias("original_id"), F.when(later, F.col("original_uri")).alias("original_uri")
    )
    small = headers.where(F.col("bytes") < min_bytes).select(
        "*", F.lit(None).cast("string").alias("original_id"), F.lit(None).cast("string").alias("original_uri")
    )
    return joined.unionByName(small) if min_bytes > 0 else joined


def write_deduplicated(files: DataFrame, resolved: DataFrame, source: str, folder: str) -> DataFrame:
    """files of new archives: each old one copied by one task, in its order, with fresh headers."""
    plan = resolved.select("part", "at", "record_id", "original_id", "original_uri").join(files.select("part", "file"), "part")
    parts = (files.agg(F.max("part")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, held, made = f"{uuid.uuid4().hex}.warc.gz", None, None, [0, 0]
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "record_id", "original_id", "original_uri", "file")), strict=True):
                part, record_id, original_id, original_uri, file = row
                if out is None:
                    files_of, path = _path(source, file)
                    stream = files_of.open_input_stream(path)
                    held = records(stream)
                    target, path = _path(folder, name)
                    target.create_dir(path.rpartition("/")[0], recursive=True)
                    out, made = target.open_output_stream(path), [part, 0]
                old, block = next(held)
                if old["warc-record-id"] != f"<{record_id}>":
                    raise ValueError(f"{file}: a record is not where its header says")
                page, uri, digest = old["warc-page-id"], old.get("warc-target-uri"), old["warc-payload-digest"].partition(":")[2]
                if original_id is None:
                    out.write(record(_headers(RESPONSE, record_id, uri, page, digest), block))
                else:
                    more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{original_id}>"), ("WARC-Refers-To-Date", DATE)]
                    more += [("WARC-Refers-To-Target-URI", original_uri)] if original_uri and original_uri.strip() else []
                    out.write(record(_headers(REVISIT, record_id, uri, page, digest, more), block[: block.index(b"\r\n\r\n") + 4]))
                made[1] += 1
        if out is not None:
            out.close()
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([made[0]], pa.int32()), pa.array([name]), pa.array([made[1]], pa.int64())], ["part", "file", "records"])

    ordered = _a_task_each(plan, parts).sortWithinPartitions("at")
    return staged(ordered.mapInArrow(run, FILES), "warc-deduplicated")


def read_archives(files: DataFrame, folder: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """A row per record of the archives: (record_id, page_id, record_type, uri, digest, refers_to, bytes[, payload]).

    bytes and digest of a response are those of the payload that stands in the file, and must agree with its header;
    a revisit has the digest of its header and null bytes.
    """
    schema = "record_id string, page_id string, record_type string, uri string, digest string, refers_to string, bytes long"
    schema += ", payload binary" if with_payload else ""
    parts = (files.agg(F.max("part")).first()[0] or 0) + 1

    def rows(stream) -> Iterator[tuple]:
        for headers, block in records(stream):
            kind, digest, payload = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2], None
            if kind == RESPONSE:
                payload = payload_of(block)
                if payload_digest(payload) != digest:
                    raise ValueError(f"{headers['warc-record-id']}: the payload is not that of its digest")
            refers = headers.get("warc-refers-to")
            row = (
                headers["warc-record-id"].strip("<>"), headers["warc-page-id"] or None, kind, headers.get("warc-target-uri"), digest,
                refers.strip("<>") if refers else None, None if payload is None else len(payload),
            )
            yield (*row, payload) if with_payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "page_id", "record_type", "uri", "digest", "refers_to", "bytes"] + (["payload"] if with_payload else [])
        kinds = [pa.string()] * 6 + [pa.int64()] + ([pa.binary()] if with_payload else [])
        limit = 64 if with_payload else 4096
        for batch in batches:
            for file in batch.column("file").to_pylist():
                files_of, path = _path(folder, file)
                held = []
                with files_of.open_input_stream(path) as stream:
                    for row in rows(stream):
                        held.append(row)
                        if len(held) == limit:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                            held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    return _a_task_each(files.select("part", "file"), parts).mapInArrow(run, schema).withColumn("page_id", F.col("page_id").cast(id_type))


def with_originals(rows: DataFrame) -> DataFrame:
    """Records with what a revisit has from the response that it refers to: its page and its payload's bytes."""
    found = staged(rows, "warc-records")
    responses = found.where(F.col("record_type") == RESPONSE)
    originals = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_page"), F.col("bytes").alias("full"))
    revisits = join_spread(found.where(F.col("record_type") == REVISIT), originals, "refers_to")
    none = F.lit(None).cast(found.schema["page_id"].dataType)
    return responses.withColumn("original_page", none).unionByName(revisits.withColumn("bytes", F.col("full")).drop("full"))


def archived(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES
) -> tuple[DataFrame, str]:
    """(files, folder) of archives of all pages, each payload of at least min_bytes bytes stored once."""
    first, folder = new_scratch(pages.sparkSession, "warc-all"), new_scratch(pages.sparkSession, "warc")
    files, headers = write_pages(pages, first, id_col, url_col, html_col)
    return write_deduplicated(files, staged(resolve(headers, min_bytes), "warc-resolved"), first, folder), folder


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row of pages, read from its archives.

    A null or empty html is the empty payload, equal to all others. Rows that repeat have a record each: of those with
    the same payload and page_id one is the response. Null ids come last when an original is chosen. A null, empty or odd url
    is written without line ends. An empty table gives none. Other columns are not read.
    """
    files, folder = archived(pages, id_col, **options)
    rows = read_archives(files, folder, pages.schema[id_col].dataType.simpleString())
    return with_originals(rows).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("original_page").alias("refers_to"),
    )


#: Base32 takes five bits a character: five hex digits are four characters.
ORACLE_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads
), based AS (
  SELECT page_id, payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
        list_reduce([strpos('0123456789abcdef', d) - 1 for d in string_split(substr(hex, 1 + 5 * (i // 4), 5), '')], lambda a, b: a * 16 + b)
        >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1) for i in range(32)], 'string_agg', '') AS payload_digest
  FROM hashed
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS place,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS original
  FROM based
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN original END AS refers_to
FROM firsts
"""
