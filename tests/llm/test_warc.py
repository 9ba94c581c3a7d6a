from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import numpy as np

from snapstrata.llm import warc
from snapstrata.llm.shared import local_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (5, "http://a/x", "<p>same</p>"), (3, "http://b/\r\nx", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "u", None), (2, "u", ""),
    (None, "u", "<p>same</p>"), (None, "u", "only here"), (7, "u", "é\r\n\r\nWARC/1.1\r\n" * 3), (8, "u", "x" * 3_000_000), (10, "u", "lone"),
]


def test_records_come_back(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=str)
    want = []
    for page, _, html in ROWS:
        same = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        kind = "response" if page == first else "revisit"
        want.append((page, len((html or "").encode()), digest(html), kind, None if kind == "response" else first))
    assert got == sorted(want, key=str)


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.archive_pages(pages, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_archives_before_and_after(spark):
    pages = spark.createDataFrame([(k, "u", f"page {k % 4} " * 50) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    records = warc.write_monolithic(pages, archive_bytes=4000)
    names = sorted({r.archive for r in records.collect()})
    assert len(names) > 1
    raw = open(local_path(names[0]), "rb").read()
    # one stream for the whole file before, a member for each record after
    whole = gzip.decompress(raw)
    assert whole.count(b"WARC/1.1\r\n") > 1
    unpacker = zlib.decompressobj(31)
    assert unpacker.decompress(raw) == whole and not unpacker.unused_data
    for r in warc.normalise(warc.decide(records)).collect():
        data = open(local_path(r.name), "rb").read()
        index = np.fromfile(local_path(r["index"]), dtype="<i8").reshape(-1, 2)
        assert len(index) == r.n and index[-1].sum() == len(data)
        for offset, length in index.tolist():
            stream = io.BytesIO(gzip.decompress(data[offset : offset + length]))
            fields, block = warc.read_record(stream)
            assert warc.read_record(stream) is None
            assert fields["WARC-Record-ID"].startswith("<urn:uuid:")
            if fields["WARC-Type"] == "revisit":
                assert fields["WARC-Profile"] == warc.REVISIT and warc.payload_of(block) == b""
        stream, n = io.BytesIO(gzip.decompress(data)), 0
        while warc.read_record(stream):
            n += 1
        assert n == r.n


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0
