"""Words of texts as Arrow arrays, without a Python object per word.

A text column is mapped byte by byte through a 256-entry table that lower-cases
A-Z and turns separators into blanks, then split by Arrow.  Bytes of multi-byte
characters are 0x80 and above in UTF-8, so the table never touches them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are worked on at once inside a task; a longer text is one piece
PIECE_BYTES = 8 << 20


def byte_table(separators: bytes) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[np.frombuffer(separators, dtype=np.uint8)] = 0x20
    return table


def blank_separated() -> np.ndarray:
    """Words are ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text."""
    return byte_table(bytes([0x20, *range(0x09, 0x0E)]))


def letters_and_digits() -> np.ndarray:
    """Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    capitals = range(ord("A"), ord("Z") + 1)
    other = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
    return byte_table(bytes(b for b in other if b not in capitals))


def as_large_strings(texts: pa.Array) -> pa.LargeStringArray:
    """Null is empty.  The result's buffers hold its texts alone, whatever slice of a batch they come from."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    out = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = out.buffers()
    if not len(out) or data is None:
        return pa.array([""] * len(out), pa.large_string())
    places = np.frombuffer(places, dtype=np.int64)[out.offset : out.offset + len(out) + 1]
    begin = int(places[0])
    return pa.LargeStringArray.from_buffers(len(out), pa.py_buffer(places - begin), data.slice(begin, int(places[-1]) - begin))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of each piece stay within the limit.

    A text above the limit makes a piece of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def split_words(texts: pa.Array, table: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All words of the texts in order, and the offsets of each text's words among them."""
    whole = as_large_strings(texts)
    if not len(whole):
        return pa.array([], pa.large_string()), np.zeros(1, dtype=np.int64)
    _, ends, data = whole.buffers()
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    mapped = pa.LargeStringArray.from_buffers(len(whole), ends, pa.py_buffer(table[raw]))
    lists = pc.ascii_split_whitespace(mapped)
    words = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return words.filter(full), kept[bounds - bounds[0]]


def coded(words: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Distinct words, and for each word its place among them."""
    encoded = words.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
