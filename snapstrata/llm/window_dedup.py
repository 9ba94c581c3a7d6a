"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Words are maximal runs of characters other than blanks (``[^\\x20\\x09-\\x0D]+``), unchanged.  A
window is ``window`` consecutive words of one document.  A window is repeated in a document if the
same words also start in a document with a smaller id; each word that a repeated window covers goes.
Windows are judged on the input, never on what is left.

How it runs:

1. A task cuts its texts into pieces of bounded size and hashes every window with two polynomials
   over 64-bit word hashes, 96 bits together: at 10^13 windows fewer than 0.002 false matches are to
   be expected in all.  Inside a piece equal windows fold to those of the smallest document; the
   others are known to be repeated at once.  A passage that sits in every document thus leaves a
   piece once, whatever its share of the rows.
2. What is left is dealt to cells, equal ranges of the hash, as sorted packed arrays.  The number of
   cells follows the bytes of text, tasks stream them one after another, and a cell marks the
   entries whose window also has a smaller document.
3. Marks are dealt out by document and merged into maximal intervals, which join the texts again by
   document.  Texts move once, compressed, in that join.

Null ids: such a row is compared with none, nothing of it goes and it removes nothing.  Rows that
share an id are documents of their own, none smaller than the other.  Null, empty and blank texts
have no words; texts with fewer words than a window keep all.  Equal rows get equal results.  An
empty table gives an empty result.  Input columns named as an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from snapstrata.llm.texts import as_large_strings, coded, pieces, split_words

#: bytes of text whose windows are hashed and folded together in a task
PIECE_BYTES = 8 << 20
#: bytes of text per cell of the hash's range, and the most cells
CELL_BYTES, MOST_CELLS = 8 << 20, 1 << 20
#: fixed odd bases of the two window polynomials
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_ENTRIES = "cell int, marked boolean, body binary"
_MARKS = "bucket int, body binary"


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of unsigned integers of one length: byte planes, compressed one by one."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts = []
    for column in columns:
        for plane in np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T:
            parts.append(squeeze(plane.tobytes()))
    sizes = np.array([len(columns[0]), *(len(p) for p in parts)], dtype="<u4")
    return b"".join([sizes.tobytes(), *parts])


def unpacked(body: bytes, kinds: list[str]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    sizes = np.frombuffer(body, dtype="<u4", count=1 + sum(widths))
    n, at = int(sizes[0]), sizes.nbytes
    expand = zstandard.ZstdDecompressor().decompress
    out, plane = [], 1
    for kind, width in zip(kinds, widths):
        planes = np.empty((width, n), dtype=np.uint8)
        for k in range(width):
            size = int(sizes[plane])
            planes[k] = np.frombuffer(expand(body[at : at + size], max_output_size=max(1, n)), dtype=np.uint8)
            at, plane = at + size, plane + 1
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
    return out


#: an entry: hash (sorted, as differences), rest of the hash, document above the smallest, variant, place
ENTRY = ["<u8", "<u4", "<u8", "<u8", "<u4"]
#: a mark: document above the smallest (sorted, as differences), variant, place
MARK = ["<u8", "<u8", "<u4"]


def _differences(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=rising.dtype.type(0))


def packed_entries(high: np.ndarray, low: np.ndarray, doc: np.ndarray, variant: np.ndarray, place: np.ndarray) -> bytes:
    least = doc.min()
    head = np.array([least], dtype="<i8").tobytes()
    above = doc.view(np.uint64) - least.view(np.uint64)
    return head + packed([_differences(high), low, above, variant, place])


def unpacked_entries(body: bytes) -> list[np.ndarray]:
    high, low, above, variant, place = unpacked(body[8:], ENTRY)
    least = np.frombuffer(body, dtype="<u8", count=1)
    return [np.cumsum(high, dtype=np.uint64), low, (above + least).view(np.int64), variant, place]


def packed_marks(doc: np.ndarray, variant: np.ndarray, place: np.ndarray) -> bytes:
    order = np.lexsort((place, variant, doc))
    doc, variant, place = doc[order], variant[order], place[order]
    least = doc[0]
    head = np.array([least], dtype="<i8").tobytes()
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1])])
    # places rise inside a document, so differences are small
    step = place.copy()
    step[1:] -= place[:-1]
    step[new] = place[new]
    return head + packed([_differences(doc.view(np.uint64) - least.view(np.uint64)), variant, step])


def unpacked_marks(body: bytes) -> list[np.ndarray]:
    steps, variant, step = unpacked(body[8:], MARK)
    least = np.frombuffer(body, dtype="<u8", count=1)
    doc = (np.cumsum(steps, dtype=np.uint64) + least).view(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1])]))
    run = np.cumsum(step, dtype=np.int64)
    before = np.repeat(run[new] - step[new], np.diff(np.append(new, len(doc))))
    return [doc, variant, (run - before).astype(np.uint32)]


def window_hashes(values: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of each run of ``window`` values; runs are put together from shorter ones."""
    out, length = None, 0
    power, size, factor = values, 1, np.uint64(base)  # power: hashes of runs of `size` values, factor: base ** size
    left = window
    while True:
        if left & 1:
            # a run so far, then a run of `size` values behind it
            out = power if out is None else out[: len(values) - length - size + 1] * factor + power[length:]
            length += size
        left >>= 1
        if not left:
            return out
        power = power[: len(values) - 2 * size + 1] * factor + power[size:]
        size, factor = 2 * size, factor * factor


def hashed_windows(texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, text, place) of every window of the texts, in order."""
    words, bounds = split_words(texts, np.arange(256, dtype=np.uint8))
    counts = np.diff(bounds)
    n = np.maximum(counts - window + 1, 0)
    if not n.sum():
        return tuple(np.zeros(0, dtype=k) for k in (np.uint64, np.uint32, np.int32, np.uint32))
    distinct, codes = coded(words)
    del words
    digests = np.frombuffer(b"".join(map(xxh3_128_digest, distinct.to_pylist())), dtype="<u8").reshape(-1, 2)
    del distinct
    text = np.repeat(np.arange(len(counts), dtype=np.int32), n)
    place = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint32)
    start = bounds[text] + place
    with np.errstate(over="ignore"):
        low = (window_hashes(digests[codes, 1], window, BASES[1])[start] >> np.uint64(32)).astype(np.uint32)
        high = window_hashes(digests[codes, 0], window, BASES[0])[start]
    return high, low, text, place


def by_window(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that puts equal windows together, rising in high, and the heads of the groups in it."""
    order = np.argsort(high, kind="stable")
    h, w = high[order], low[order]
    same = h[1:] == h[:-1]
    if np.any(same & (w[1:] != w[:-1])):
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
        same = h[1:] == h[:-1]
    return order, np.flatnonzero(np.concatenate([[True], ~same | (w[1:] != w[:-1])]))


def cell_of(high: np.ndarray, cells: int) -> np.ndarray:
    return ((high >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)


def _with_variant(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Adds _variant: 0, or where several rows share an id, a hash that tells their texts apart."""
    several = docs.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("_several")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if several.isEmpty():
        return docs.withColumn("_variant", F.lit(0).cast("long"))
    own = F.when(F.col("_several").isNotNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))
    joined = docs.join(several.select("_several"), F.col(id) == F.col("_several"), "left")
    return joined.withColumn("_variant", own).drop("_several")


def _entries(docs: DataFrame, window: int, cells: int) -> DataFrame:
    """Rows (cell, marked, body): windows to compare by cell, and marks that are known already (cell: any)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", PIECE_BYTES):
            # by id, so that a stable order of the windows has the smallest document first
            piece = piece.sort_by("_id")
            high, low, text, place = hashed_windows(piece.column("_text"), window)
            if not len(high):
                continue
            ids = piece.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
            variants = piece.column("_variant").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            order, heads = by_window(high, low)
            high, low, text, place = high[order], low[order], text[order], place[order]
            doc, variant = ids[text], variants[text]
            least = np.repeat(doc[heads], np.diff(np.append(heads, len(doc))))
            known = doc > least
            rows = []
            if known.any():
                rows.append((int(cell_of(high[:1], cells)[0]), True, packed_marks(doc[known], variant[known], place[known])))
            kept = np.flatnonzero(~known)
            cell = cell_of(high[kept], cells)
            cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            for first, last in zip(cuts.tolist(), [*cuts[1:].tolist(), len(cell)]):
                at = kept[first:last]
                rows.append((int(cell[first]), False, packed_entries(high[at], low[at], doc[at], variant[at], place[at])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.binary()))], names=["cell", "marked", "body"]
            )

    return docs.mapInArrow(run, _ENTRIES)


def _dealt_marks(doc: np.ndarray, variant: np.ndarray, place: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    mixed = (doc.view(np.uint64) ^ variant) * np.uint64(BASES[0])
    bucket = cell_of(mixed, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, doc, variant, place = bucket[order], doc[order], variant[order], place[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for first, last in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        yield int(bucket[first]), packed_marks(doc[first:last], variant[first:last], place[first:last])


def _marks(entries: DataFrame, tasks: int, buckets: int) -> DataFrame:
    """Rows (bucket, body) of the places where repeated windows start."""

    def compare(bodies: list[bytes]) -> list[tuple[int, bytes]]:
        high, low, doc, variant, place = (np.concatenate(c) for c in zip(*map(unpacked_entries, bodies)))
        order, heads = by_window(high, low)
        doc, variant, place = doc[order], variant[order], place[order]
        least = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(doc))))
        found = doc > least
        return list(_dealt_marks(doc[found], variant[found], place[found], buckets)) if found.any() else []

    def batch_of(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], names=["bucket", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                cell, marked, body = (batch.column(k)[row].as_py() for k in range(3))
                if cell != held and bodies:
                    yield batch_of(compare(bodies))
                    bodies = []
                held = cell
                if marked:
                    yield batch_of(list(_dealt_marks(*unpacked_marks(body), buckets)))
                else:
                    bodies.append(body)
        if bodies:
            yield batch_of(compare(bodies))

    dealt = entries.repartition(tasks, "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, _MARKS)


def _intervals(marks: DataFrame, tasks: int, window: int) -> DataFrame:
    """(_id, _variant, _first, _last): per document the maximal intervals of words that repeated windows cover."""
    schema = T.StructType.fromDDL("_id long, _variant long, _first array<int>, _last array<int>")

    def merge(bodies: list[bytes]) -> pa.RecordBatch:
        doc, variant, place = (np.concatenate(c) for c in zip(*map(unpacked_marks, bodies)))
        order = np.lexsort((place, variant, doc))
        doc, variant, place = doc[order], variant[order], place[order].astype(np.int64)
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1])])
        # windows that overlap or touch make one interval
        opens = new | np.concatenate([[True], place[1:] > place[:-1] + window])
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(place)) - 1
        own = np.flatnonzero(new)
        offsets = np.append(np.searchsorted(first, own), len(first)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in (place[first], place[last] + window)]
        return pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(variant[own].view(np.int64)), *lists], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies = None, []
        for batch in batches:
            for bucket, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != held and bodies:
                    yield merge(bodies)
                    bodies = []
                held = bucket
                bodies.append(body.as_py())
        if bodies:
            yield merge(bodies)

    return marks.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _squeezed(read: DataFrame) -> DataFrame:
    """Texts compressed, for the one join that moves them; null and empty ones are null."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "_text" else f for f in read.schema])
    names = read.columns
    place = names.index("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for piece in pieces(batches, "_text"):
            values = (x.as_buffer() for x in as_large_strings(piece.column(place)))
            small = pa.array([squeeze(x) if x.size else None for x in values], pa.binary())
            yield pa.RecordBatch.from_arrays([small if k == place else piece.column(k) for k in range(piece.num_columns)], names=names)

    return read.mapInArrow(run, schema)


def removal_intervals(docs: DataFrame, window: int = 13, id: str = "doc_id", text: str = "text", cells: int | None = None) -> DataFrame:
    """(_id, _variant, _first, _last) of the documents that lose words: word numbers, first to before last.

    _variant is 0, or a hash of the text where several rows share an id.  cells: by default
    from the bytes of text.
    """
    read = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    return _found(_with_variant(read, "_id", "_text"), window, cells)


def _found(read: DataFrame, window: int, cells: int | None) -> DataFrame:
    if window < 1:
        raise ValueError("a window has at least one word")
    if cells is None:
        size = read.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
        cells = min(MOST_CELLS, 1 + size // CELL_BYTES)
    tasks = min(cells, int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = read.where(F.col("_id").isNotNull() & F.col("_text").isNotNull()).select("_id", "_variant", "_text")
    return _intervals(_marks(_entries(rows, window, cells), tasks, cells), tasks, window)


def remove_repeated_windows(
    docs: DataFrame, window: int = 13, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, cells: int | None = None
) -> DataFrame:
    """The columns in keep (all others by default), n_words, n_removed and kept_text: kept words joined by one blank."""
    outputs = ("n_words", "n_removed", "kept_text")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in outputs and (keep is not None or c != text)]
    read = docs.select(F.struct(*kept).alias("_row"), F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    read = _with_variant(read, "_id", "_text")
    joined = _squeezed(read).join(_found(read, window, cells), ["_id", "_variant"], "left")
    schema = T.StructType([*docs.select(*kept).schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for piece in pieces(batches, "_text", PIECE_BYTES // 4):
            totals, removed, out = [], [], []
            for value, first, last in zip(*(piece.column(c).to_pylist() for c in ("_text", "_first", "_last"))):
                words = expand(value).split() if value else []
                totals.append(len(words))
                if first:
                    held, at = [], 0
                    for begin, end in zip(first, last):
                        held += words[at:begin]
                        at = end
                    words = held + words[at:]
                removed.append(totals[-1] - len(words))
                out.append(b" ".join(words))
            row = piece.column("_row")
            yield pa.RecordBatch.from_arrays(
                [*row.flatten(), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                names=schema.names,
            )

    return joined.select("_row", "_text", "_first", "_last").mapInArrow(run, schema)
