"""WARC archives: written monolithic, normalised to a gzip member per record, read back by offset.

Writing streams pages into archives that are one gzip stream each, as crawlers without
record compression leave them; no record of such a file can be reached but by inflating all before it.
The normaliser inflates each stream once, record by record, and rewrites every record as a gzip member
of its own, with the members' offsets and lengths in a sidecar index of 64-bit integers.
On the way, of records with equal payloads the one with the smallest page_id stays a response and
the others become revisits that refer to it; payloads below ``min_bytes`` all stay.
Payloads are never shuffled: only digests and decisions are.

Null html is an empty payload.  Line breaks in a url are percent-encoded.  Pages without an id
come last in the choice of the response; repeated ids are taken in the order of
their records.  What a revisit says of its payload (digest and length) stands in its header.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.shared import attempt_name, mapped_array, open_input, open_output, shared_folder, stored
from snapstrata.llm.texts import pieces

#: uncompressed bytes after which a new archive is begun
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
READ_ROWS = 2048


def payload_digest(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def http_block(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def read_record(stream) -> tuple[dict[str, str], bytes] | None:
    """The next record's named fields and block; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
        fields[name.strip()] = value.strip()
    size = int(fields["Content-Length"])
    block = stream.read(size)
    if len(block) != size:
        raise ValueError("the archive ends inside a record")
    return fields, block


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


class _Monolith:
    """One gzip stream for all records of an archive."""

    def __init__(self, folder: str):
        stem = attempt_name(f"crawl-{TaskContext.get().partitionId():06d}", ".warc.gz")
        self.name, self.n, self.size = f"{folder}/{stem}", 0, 0
        self.out = open_output(self.name)
        self.packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def add(self, data: bytes) -> None:
        self.out.write(self.packer.compress(data))
        self.n, self.size = self.n + 1, self.size + len(data)

    def close(self) -> None:
        self.out.write(self.packer.flush())
        self.out.close()


def write_monolithic(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write the archives; returns a stored table with a row per record: archive, number, page_id, digest."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    read = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for piece in pieces(batches, "html"):
            rows = []
            for page, address, text in zip(*(piece.column(k).to_pylist() for k in range(3))):
                archive = archive or _Monolith(folder)
                payload = (text or "").encode("utf-8", "surrogatepass")
                digest = payload_digest(payload)
                fields = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive.name}#{archive.n}')}>"),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", (address or "").replace("\r", "%0D").replace("\n", "%0A")),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if page is not None:
                    fields.append(("X-Page-ID", str(page)))
                rows.append((archive.name, archive.n, page, digest, len(payload)))
                archive.add(record(fields, http_block(payload)))
                if archive.size >= archive_bytes:
                    archive.close()
                    archive = None
            columns = zip(*rows)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["archive", "number", "page_id", "digest", "size"])
        if archive is not None:
            archive.close()

    return stored(read.mapInArrow(run, "archive string, number long, page_id long, digest string, size long"), "records")


def decide(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """archive, number, revisit (boolean), refers_to of every record."""
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "archive", "number")
    first = records.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min(order).alias("first"))
    revisit = F.coalesce((F.col("first.archive") != F.col("archive")) | (F.col("first.number") != F.col("number")), F.lit(False))
    return records.join(first, ["digest", "size"], "left").select(
        "archive", "number", revisit.alias("revisit"), F.when(revisit, F.col("first.page_id")).alias("refers_to"),
        F.when(revisit, F.concat_ws("#", "first.archive", F.col("first.number").cast("string"))).alias("original"),
    )


def _as_revisit(fields: dict[str, str], block: bytes, refers_to: int | None, original: str) -> bytes:
    head = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
    kept = [(k, v) for k, v in fields.items() if k not in ("Content-Length", "WARC-Type")]
    new = [
        ("WARC-Type", "revisit"),
        *kept,
        ("WARC-Profile", REVISIT),
        ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, original)}>"),
        ("X-Payload-Length", str(len(block) - len(head))),
    ]
    if refers_to is not None:
        new.append(("X-Refers-To-Page-ID", str(refers_to)))
    return record(new, head)


def normalise(decisions: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite each archive with a gzip member per record and a sidecar index; a stored row per archive: name, index, n."""
    spark = decisions.sparkSession
    folder = folder or shared_folder(spark, "warc")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = decisions.repartition(tasks, "archive").sortWithinPartitions("archive", "number")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(5)))

    def rewrite(source: str, first: tuple, rest: Iterator[tuple]) -> tuple[dict, tuple | None]:
        stem = source.rpartition("/")[2].removesuffix(".warc.gz")
        name = f"{folder}/{attempt_name(stem, '.warc.gz')}"
        ends, row = [0], first
        with open_input(source) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as stream, open_output(name) as out:
            while row is not None and row[0] == source:
                _, number, revisit, refers_to, original = row
                if number != len(ends) - 1:
                    raise ValueError(f"{source}: record {len(ends) - 1} has no decision")
                fields, block = read_record(stream)
                if revisit:
                    data = _as_revisit(fields, block, refers_to, original)
                else:
                    data = record([(k, v) for k, v in fields.items() if k != "Content-Length"], block)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(data) + packer.flush()
                out.write(member)
                ends.append(ends[-1] + len(member))
                row = next(rest, None)
            if read_record(stream) is not None:
                raise ValueError(f"{source} holds more records than decisions")
        index = f"{name}.idx"
        with open_output(index) as out:
            bounds = np.array(ends, dtype="<i8")
            out.write(np.stack([bounds[:-1], np.diff(bounds)], axis=1).tobytes())
        return {"name": name, "index": index, "n": len(ends) - 1}, row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = rows(batches)
        row = next(rest, None)
        while row is not None:
            done, row = rewrite(row[0], row, rest)
            yield pa.RecordBatch.from_pylist([done])

    return stored(dealt.mapInArrow(run, "name string, index string, n long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record, from the archives: each is reached by its offset in the sidecar index.

    page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def number(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with open_input(name) as source:
                    for offset, length in mapped_array(index, "<i8").reshape(-1, 2).tolist():
                        source.seek(offset)
                        fields, block = read_record(io.BytesIO(gzip.decompress(source.read(length))))
                        kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "revisit":
                            size = number(fields, "X-Payload-Length")
                        else:
                            payload = payload_of(block)
                            size = len(payload)
                            if payload_digest(payload) != stated:
                                raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                        rows.append((number(fields, "X-Page-ID"), size, stated, kind, number(fields, "X-Refers-To-Page-ID")))
                        if len(rows) == READ_ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("name", "index").repartition(tasks).mapInArrow(run, schema)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back: a row per page."""
    records = write_monolithic(pages, page_id, url, html)
    return read_archives(normalise(decide(records, min_bytes)))
