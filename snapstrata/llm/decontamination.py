"""Benchmark decontamination with suffix arrays over shards of the training text.

Each shard of documents (a few megabytes of text inside a task) gets a suffix
array over its words.  Every suffix of every test item is binary-searched in it;
where the window that starts the suffix occurs, the range found holds all its
locations.  Locations on one diagonal are joined to the longest verbatim
matches.  A window is ``window`` consecutive words of an item; an item of fewer
words, but not none, is one window.

Suffixes that do not start with the first words of any window can match none, so
they are left out of the arrays, which makes them sparse but changes no match.

The test items are encoded once, in blocks of bounded size, one broadcast each,
and a task holds one block at a time; the documents are read once whatever the
number of blocks, and never shuffled.

Null and empty texts have no words and are clean.  Items without an id or words
are not searched for.  Items of equal words are searched for once and all reported; an
item_id with several texts counts as one item, found if any of them is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.shared import Shipped
from snapstrata.llm.texts import letters_and_digits, pieces, split_words

WINDOW = 13
#: bytes of test texts in a block
BLOCK_BYTES = 16 << 20
#: a text is contaminated if at least this part of its words is hit: 1 in 20
ONE_IN = 20


@dataclass(frozen=True)
class TestBlock:
    """Test items as word numbers, 1 and up; equal items are one entry with all their ids."""

    __test__ = False

    vocabulary: list[str]
    words: np.ndarray
    ends: np.ndarray
    names: list[list[str]]
    window: int

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of every window among the words."""
        starts, sizes = [], []
        for first, last in zip(self.ends[:-1].tolist(), self.ends[1:].tolist()):
            n = max(1, last - first - self.window + 1)
            starts.append(np.arange(first, first + n))
            sizes.append(np.full(n, min(self.window, last - first)))
        if not starts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(starts), np.concatenate(sizes)


def encode_items(ids: list, texts: list[str], window: int) -> TestBlock:
    words, ends = split_words(pa.array(texts, pa.large_string()), letters_and_digits())
    by_words: dict[tuple[str, ...], set[str]] = {}
    spoken = words.to_pylist()
    for k, name in enumerate(ids):
        key = tuple(spoken[ends[k] : ends[k + 1]])
        if key and name is not None:
            by_words.setdefault(key, set()).add(str(name))
    number: dict[str, int] = {}
    flat = [number.setdefault(w, len(number) + 1) for key in by_words for w in key]
    bounds = np.cumsum([0, *map(len, by_words)])
    return TestBlock(list(number), np.array(flat, dtype=np.int64), bounds, [sorted(v) for v in by_words.values()], window)


def _packed(ids: np.ndarray, at: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """The next ``depth`` words from each place, several to a 63-bit key; 0 past the end."""
    per = 63 // bits
    padded = np.concatenate([ids, np.zeros(depth + per, dtype=ids.dtype)]).astype(np.uint64)
    keys = np.zeros((-(-depth // per), len(at)), dtype=np.uint64)
    for offset in range(depth):
        keys[offset // per] |= padded[at + offset] << np.uint64(bits * (per - 1 - offset % per))
    return keys


def _insertion(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Binary search of each wanted key sequence among the sorted ones: the first place not below it."""
    low = np.zeros(wanted.shape[1], dtype=np.int64)
    high = np.full(wanted.shape[1], keys.shape[1], dtype=np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = np.where(open_, (low + high) // 2, 0)
        below, equal = np.zeros(len(low), dtype=bool), np.ones(len(low), dtype=bool)
        for level in range(len(keys)):
            have = keys[level][middle]
            below |= equal & (have < wanted[level])
            equal &= have == wanted[level]
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)


class SuffixSearch:
    """What the shards share of a block: its windows as search keys."""

    def __init__(self, block: TestBlock):
        self.block = block
        self.bits = max(1, len(block.vocabulary).bit_length())
        self.values = pa.array(block.vocabulary, pa.large_string())
        starts, sizes = block.windows()
        self.starts, self.sizes = starts, sizes
        self.item = np.repeat(np.arange(len(block.names)), np.maximum(1, np.diff(block.ends) - block.window + 1))
        if not len(starts):
            return
        self.depth = int(sizes.max())
        # words past a window's end, in the item, are no part of the search key
        low = _packed(block.words, starts, self.depth, self.bits)
        per, high = 63 // self.bits, np.zeros_like(low)
        for offset in range(self.depth):
            place = self.bits * (per - 1 - offset % per)
            mask = np.uint64(((1 << self.bits) - 1) << place)
            outside = sizes <= offset
            low[offset // per][outside] &= ~mask
            high[offset // per][outside] |= mask
        self.low, self.high = low, low | high
        # equal windows of different items are searched for once
        both = np.concatenate([low, sizes[None, :].astype(np.uint64)])
        _, self.first, self.same = np.unique(both, axis=1, return_index=True, return_inverse=True)
        self.same = self.same.reshape(-1)
        self.lead = int(min(sizes.min(), max(1, min(3, 63 // self.bits))))
        self.leads = np.unique(_packed(block.words, starts[self.first], self.lead, self.bits)[0])

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct window, place in the shard) of all occurrences."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.starts):
            return none, none
        at = np.flatnonzero(ids)
        if self.lead > 1:
            start = _packed(ids, at, self.lead, self.bits)[0]
            at = at[self.leads[np.searchsorted(self.leads[:-1], start)] == start]
        if not len(at):
            return none, none
        keys = _packed(ids, at, self.depth, self.bits)
        order = np.lexsort(keys[::-1])
        suffixes, keys = at[order], keys[:, order]
        first = _insertion(keys, self.low[:, self.first])
        # the place behind the last suffix that starts with the window
        behind = self.high[:, self.first].copy()
        behind[-1] += np.uint64(1)
        last = _insertion(keys, behind)
        n = last - first
        found = np.repeat(np.arange(len(n)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return found, suffixes[np.repeat(first, n) + within]


def scan_texts(texts: pa.Array, searches: Iterable[SuffixSearch]) -> list[dict]:
    """For each text: n_words, n_hit, item_ids and its longest verbatim match per item."""
    words, ends = split_words(texts, letters_and_digits())
    n_docs = len(texts)
    owner = np.repeat(np.arange(n_docs), np.diff(ends))
    # a zero between texts keeps windows from crossing over
    place = np.arange(len(words)) + owner
    encoded = words.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    hit = np.zeros(len(words) + n_docs + 1, dtype=np.int64)
    out = [{"n_words": int(n), "n_hit": 0, "item_ids": set(), "matches": []} for n in np.diff(ends)]
    starts = ends[:-1] + np.arange(n_docs)
    for search in searches:
        number = pc.fill_null(pc.index_in(encoded.dictionary, value_set=search.values), -1).to_numpy(zero_copy_only=False)
        ids = np.zeros(len(words) + n_docs + 1, dtype=np.int64)
        if len(words):
            ids[place] = number.astype(np.int64)[codes] + 1
        found, at = search.matches(ids)
        if not len(found):
            continue
        np.add.at(hit, at, 1)
        np.add.at(hit, at + search.sizes[search.first[found]], -1)
        # every item that holds the window
        by_window = np.argsort(search.same, kind="stable")
        n_same = np.bincount(search.same, minlength=len(search.first))
        begin = np.cumsum(n_same) - n_same
        n = n_same[found]
        every = by_window[np.repeat(begin[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        at = np.repeat(at, n)
        item, size = search.item[every], search.sizes[every]
        doc = np.searchsorted(starts, at, side="right") - 1
        diagonal = at - search.starts[every]
        order = np.lexsort((at, diagonal, item, doc))
        item, size, doc, diagonal, at = (x[order] for x in (item, size, doc, diagonal, at))
        new = np.ones(len(at), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        for h, t in zip(head.tolist(), tail.tolist()):
            row, k = out[doc[h]], int(item[h])
            row["item_ids"].update(search.block.names[k])
            inside = int(at[h] - diagonal[h] - search.block.ends[k])
            row["matches"].append((search.block.names[k][0], int(at[h] - starts[doc[h]]), inside, int(at[t] + size[t] - at[h])))
    if len(words):
        covered = np.cumsum(hit)[place] > 0
        for doc, n in enumerate(np.bincount(owner, weights=covered, minlength=n_docs).astype(int).tolist()):
            out[doc]["n_hit"] = n
    for row in out:
        row["item_ids"] = sorted(row["item_ids"])
        row["matches"].sort(key=lambda m: (-m[3], m[0], m[1], m[2]))
    return out


def broadcast_items(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list:
    """One broadcast per block of items; the driver holds one block at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = total // block_bytes + 1
    out = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()
        out.append(Shipped(spark, encode_items([r.id for r in rows], [r.text for r in rows], window)))
    return out


def _scanner(blocks: list, text: str):
    """Piece by piece, the rows found; a single block's keys are made once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
        only = SuffixSearch(blocks[0].value) if len(blocks) == 1 else None
        for piece in pieces(batches, text):
            searches = [only] if only is not None else (SuffixSearch(b.value) for b in blocks)
            yield piece, scan_texts(piece.column(text), searches)

    return run


MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("doc_word", T.LongType()),
        T.StructField("item_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, one_in: int = ONE_IN, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row per document: n_words, n_hit, item_ids, matches (longest first), contaminated."""
    scan = _scanner(broadcast_items(benchmark, item_id, item_text, window, block_bytes), text)
    read = docs.select(*dict.fromkeys([doc_id, text]))
    schema = T.StructType(
        [
            read.schema[doc_id],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
            T.StructField("matches", T.ArrayType(MATCH)),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )
    match = pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows in scan(batches):
            matches = [[dict(zip(("item_id", "doc_word", "item_word", "n_words"), m)) for m in r["matches"]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(doc_id),
                    pa.array([r["n_words"] for r in rows], pa.int64()),
                    pa.array([r["n_hit"] for r in rows], pa.int64()),
                    pa.array([r["item_ids"] for r in rows], pa.list_(pa.string())),
                    pa.array(matches, pa.list_(match)),
                    pa.array([r["n_hit"] > 0 and one_in * r["n_hit"] >= r["n_words"] for r in rows], pa.bool_()),
                ],
                names=schema.names,
            )

    return read.mapInArrow(run, schema)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, one_in: int = ONE_IN, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """docs without the contaminated ones, all columns as they are."""
    scan = _scanner(broadcast_items(benchmark, item_id, item_text, window, block_bytes), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows in scan(batches):
            clean = [not (r["n_hit"] > 0 and one_in * r["n_hit"] >= r["n_words"]) for r in rows]
            yield piece.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
