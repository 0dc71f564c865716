"""Archives against a plain dictionary of payloads, their format against a reader of its own."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest
from oracle_compare import compare, connect

from parcelflow.llm import warc
from parcelflow.llm.common import table

SCHEMA = "page_id long, url string, html string, part int, file string, digest string, bytes long"


def _plain(rows, least=0):
    """Digest, type and target per row; of rows with the same id and payload any one may be the response."""
    firsts = {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        firsts.setdefault((html or "").encode(), page)
    out, taken = [], set()
    for page, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = len(raw) < least or (firsts[raw] == page and raw not in taken)
        taken |= {raw} if first else set()
        out.append((str(page), len(raw), digest, "response" if first else "revisit", None if first else firsts[raw]))
    return sorted(map(str, out))


def _got(df):
    return sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in df.collect())


ODD = [
    (5, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, None, None), (7, "", ""),
    (None, "http://b\r\nX-Evil: 1", "<p>one</p>"), (None, None, "only here"), (None, " ", "only here"), (11, "u", "naïve 漢字 😀\r\n\r\nWARC/1.1\r\n"),
    (12, "u", "long " * 400_000), (13, "v", "long " * 400_000), (14, "w", "<p>two</p>"),
]


@pytest.mark.parametrize("least", [0, 1, 11])
def test_odd_pages(spark, least):
    pages = spark.createDataFrame([(*r, 1, "f", "d", 2) for r in ODD], SCHEMA).repartition(3)
    assert _got(warc.round_trip(pages, min_bytes=least)) == _plain(ODD, least)


def test_empty_tables_and_a_hot_payload(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(pages).count() == 0
    hot = [(i, f"http://h/{i}", "same" if i % 3 else f"own {i}") for i in range(3000)]
    assert _got(warc.round_trip(spark.createDataFrame([(*r, 1, "f", "d", 2) for r in hot], SCHEMA).repartition(6))) == _plain(hot)


def test_equals_sql(spark, sf_dir):
    run = lambda s, d: warc.round_trip(table(s, d, "pages"))
    assert compare(spark, connect(sf_dir), "warc", run, warc.ORACLE_SQL, sf_dir) == []


def test_payloads_come_back_and_repeated_ones_are_stored_once(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").repartition(4)
    files, folder = warc.archived(pages)
    rows = warc.read_archives(files, folder, with_payload=True).collect()
    want = {r.page_id: (r.url, (r.html or "").encode()) for r in pages.collect()}
    held = {r.record_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert len(rows) == len(want) and len(held) == len({p for _, p in want.values()})
    assert all(held[r.refers_to or r.record_id] == want[r.page_id][1] and r.uri == want[r.page_id][0] for r in rows)
    assert files.agg({"records": "sum"}).first()[0] == len(rows)


def test_records_are_gzip_members_that_other_readers_understand(spark):
    pages = spark.createDataFrame([(1, "http://x/", "<p>é</p>"), (2, "http://y/", "<p>é</p>")], "page_id long, url string, html string").coalesce(1)
    files, folder = warc.archived(pages)
    opened, path = warc._path(folder, files.first().file)
    raw = opened.open_input_stream(path).read()
    text = gzip.decompress(raw)
    first, second = (b"WARC/1.1\r\n" + x for x in text.split(b"WARC/1.1\r\n")[1:])
    head, block = first.split(b"\r\n\r\n", 1)
    size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
    assert block[size:] == b"\r\n\r\n" and block[:size].endswith("\r\n\r\n<p>é</p>".encode()) and b"WARC-Type: response" in head
    assert b"WARC-Type: revisit" in second and b"WARC-Refers-To: <urn:uuid:" in second and b"WARC-Refers-To-Target-URI: http://x/" in second
    assert "<p>é</p>".encode() not in second
    assert len(list(warc.records(io.BytesIO(raw)))) == 2
    with pytest.raises(EOFError):
        list(warc.records(io.BytesIO(raw[:-5])))
