"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt out by ranges of their id and sorted within each range.  A
task encodes its range and appends the ids to a flat file of little-endian unsigned
integers (16 bits where the vocabulary fits, 32 otherwise).  The number of ids in
each range is known then; prefix sums over the ranges give each its base, and a
second, small pass writes the offsets of all documents as 64-bit integers.
The files are memory mapped for reading.

A range has three files: ids; offsets, one more than documents, counted over all
ranges; and documents, pairs of 64-bit integers (doc_id, 1, or 0, 0 for a null id).
Rows without a doc_id come first, rows of equal ids in the order they are read.
Null and empty texts hold the end id alone.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.shared import attempt_name, mapped_array, open_output, shared_folder
from snapstrata.llm.texts import as_large_strings, blank_separated, coded, pieces

#: documents that are read back at once
READ_ROWS = 4096
#: distinct words whose ids a task keeps
REMEMBERED = 500_000


@dataclass(frozen=True)
class Range:
    """The files of one range of documents."""

    number: int
    ids: str
    documents: str
    n_docs: int
    n_tokens: int
    base: int = 0
    offsets: str = ""


class WordEncoder:
    """Encodes whole texts with the tokenizers library, each distinct part of a text once.

    The tokenizer normalizes with NFC, blanks and lower case, drops white space, and splits
    letters, digits and the rest, so a text's ids are those of its parts in order.  Parts end
    at blanks, and before one of .,!?;: that follows a letter.  What could tell a text from
    its parts is left to the library as a whole: texts with combining marks (they may
    compose with what stands before) or with a special token's opening.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, list[int]] = {}
        self.table = blank_separated()
        self.letter, self.stop = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
        self.letter[ord("a") : ord("z") + 1] = True
        self.stop[np.frombuffer(b".,!?;:", dtype=np.uint8)] = True
        # the library's own alphabet of the byte level, by byte
        self.alphabet = _byte_alphabet()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def parts(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The parts of all texts, and the offsets of each text's parts."""
        _, places, data = texts.buffers()
        if data is None or not len(texts):
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, dtype=np.int64)
        places = np.frombuffer(places, dtype=np.int64)[: len(texts) + 1]
        raw = self.table[np.frombuffer(data, dtype=np.uint8)[: places[-1]]]
        filled = raw != 0x20
        begins = np.zeros(len(raw) + 1, dtype=bool)
        begins[places] = True
        starts = begins[:-1] & filled
        starts[1:] |= filled[1:] & (~filled[:-1] | self.stop[raw[1:]] & self.letter[raw[:-1]])
        dense = np.concatenate([[0], np.cumsum(filled)])
        at = np.flatnonzero(starts)
        ends = np.append(dense[at], dense[-1])
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(raw[filled]))
        return parts, np.searchsorted(at, places)

    def ids_of(self, distinct: pa.LargeStringArray) -> list[list[int]]:
        """Lower-case Latin letters alone are one pre-token, so the library's model is asked directly."""
        plain = pc.match_substring_regex(distinct, "^[a-zß-öø-ÿœ]+$").to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, tokenize, alphabet = self.known, self.tokenizer.model.tokenize, self.alphabet
        out = []
        for part, letters in zip(distinct.to_pylist(), plain):
            ids = known.get(part)
            if ids is None:
                if letters:
                    spelled = part if part.isascii() else "".join([alphabet[b] for b in part.encode()])
                    ids = [token.id for token in tokenize(spelled)]
                else:
                    ids = self.whole(part)
                known[part] = ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the end id, and the number of ids of each text."""
        whole = as_large_strings(texts)
        parts, ends = self.parts(whole)
        distinct, codes = coded(parts)
        found = self.ids_of(distinct)
        # the end id is one more part behind each text
        found.append([end_id])
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))
        codes = np.insert(codes, ends[1:], len(found) - 1)
        starts = np.cumsum(sizes) - sizes
        n = sizes[codes]
        ids = flat[np.repeat(starts[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        bounds = np.concatenate([[0], np.cumsum(n)])[ends + np.arange(len(ends))]
        odd = pc.match_substring_regex(whole, "<\\||\\p{M}")
        for row in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()[::-1]:
            own = np.array([*self.whole(whole[row].as_py()), end_id], dtype=np.uint32)
            ids = np.concatenate([ids[: bounds[row]], own, ids[bounds[row + 1] :]])
            bounds[row + 1 :] += bounds[row] + len(own) - bounds[row + 1]
        return ids, np.diff(bounds)


def _byte_alphabet() -> list[str]:
    """Byte-level models write printable bytes as themselves and the others as the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    out = [""] * 256
    for b in printable:
        out[b] = chr(b)
    for k, b in enumerate(others):
        out[b] = chr(256 + k)
    return out


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, doc_id: str = "doc_id", text: str = "text",
    folder: str | None = None,
) -> list[Range]:
    """Write the files below a fresh shared folder (or the given one); returns one entry per range that has documents."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    kind = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges, "id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        ids_name = f"{folder}/{attempt_name(f'ids-{number:06d}', '.bin')}"
        documents_name = f"{folder}/{attempt_name(f'documents-{number:06d}', '.bin')}"
        counts_name = f"{folder}/{attempt_name(f'counts-{number:06d}', '.bin')}"
        encoder, n_docs, n_tokens = WordEncoder(tokenizer), 0, 0
        with open_output(ids_name) as ids_out, open_output(documents_name) as documents_out, open_output(counts_name) as counts_out:
            for piece in pieces(batches, "text"):
                ids, counts = encoder.encode(piece.column("text"), end_id)
                ids_out.write(ids.astype(kind).tobytes())
                names = piece.column("id")
                known = pc.is_valid(names).to_numpy(zero_copy_only=False)
                pairs = np.stack([pc.fill_null(names, 0).to_numpy(zero_copy_only=False).astype("<i8"), known.astype("<i8")], axis=1)
                documents_out.write(pairs.tobytes())
                counts_out.write(counts.astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + piece.num_rows, n_tokens + len(ids)
        row = {"number": number, "ids": ids_name, "documents": documents_name, "counts": counts_name, "n_docs": n_docs, "n_tokens": n_tokens}
        yield pa.RecordBatch.from_pylist([row])

    first = ordered.mapInArrow(run, "number long, ids string, documents string, counts string, n_docs long, n_tokens long")
    # a row per range; what failed or repeated attempts wrote is in no row
    rows = sorted((r for r in first.collect() if r.n_docs), key=lambda r: r.number)
    bases = [0]
    for r in rows:
        bases.append(bases[-1] + r.n_tokens)
    counts = {k: (r.counts, bases[k]) for k, r in enumerate(rows)}

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                source, base = counts[k]
                name = f"{folder}/{attempt_name(f'offsets-{k:06d}', '.bin')}"
                n = mapped_array(source, "<i8")
                with open_output(name) as out:
                    out.write((base + np.concatenate([[0], np.cumsum(n)])).astype("<i8").tobytes())
                yield pa.RecordBatch.from_pylist([{"k": k, "name": name}])

    numbered = spark.range(0, len(rows), 1, max(1, len(rows)))
    names = {r.k: r.name for r in numbered.mapInArrow(offsets, "k long, name string").collect()}
    return [Range(r.number, r.ids, r.documents, r.n_docs, r.n_tokens, bases[k], names[k]) for k, r in enumerate(rows)]


class TokenReader:
    """The ids of the n-th document of a set of files, memory mapped."""

    def __init__(self, ranges: list[Range], vocabulary: int):
        self.kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
        self.ranges = ranges
        self.first = [0]
        for r in ranges:
            self.first.append(self.first[-1] + r.n_docs)
        self.mapped: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return self.first[-1]

    def files(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k not in self.mapped:
            r = self.ranges[k]
            documents = mapped_array(r.documents, "<i8").reshape(-1, 2)
            self.mapped[k] = mapped_array(r.ids, self.kind), mapped_array(r.offsets, "<i8"), documents
        return self.mapped[k]

    def __getitem__(self, n: int) -> tuple[int | None, int, np.ndarray]:
        """doc_id, start and ids."""
        k = bisect_right(self.first, n) - 1
        ids, offsets, documents = self.files(k)
        at, base = n - self.first[k], self.ranges[k].base
        name = int(documents[at, 0]) if documents[at, 1] else None
        return name, int(offsets[at]), ids[offsets[at] - base : offsets[at + 1] - base]


def read_token_files(spark: SparkSession, ranges: list[Range], vocabulary: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as 32-bit integers) of every document, from the files."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TokenReader(ranges, vocabulary)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                ids, offsets, documents = reader.files(k)
                base = ranges[k].base
                for at in range(0, len(documents), READ_ROWS):
                    bounds = np.array(offsets[at : at + READ_ROWS + 1])
                    own = documents[at : at + READ_ROWS]
                    places = (bounds - base).tolist()
                    crcs = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(places[:-1], places[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[:, 0], pa.int64(), mask=own[:, 1] == 0),
                            pa.array(bounds[:-1], pa.int64()),
                            pa.array(np.diff(bounds), pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=schema.names,
                    )
                reader.mapped.clear()

    return spark.range(0, len(ranges), 1, max(1, len(ranges))).mapInArrow(run, schema)
