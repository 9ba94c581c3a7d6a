"""N-gram language model in an Elias-Fano trie, and scores of whole texts by it.

Level 1 is the vocabulary: sorted 64-bit hashes of the training tokens with their
counts.  A node of level k is one of level k - 1, its context, and a next word.  Nodes are sorted
by (context, word) and kept in shards: monotone pointers give the range of each
context's successors, and the words in it, added to what came before so that
they rise throughout, are found by a search for the successor inside that range.
With every node goes its discounted probability and with every context the mass that
is left to the shorter context, both quantised logarithms:

    p(w | c) = (n(c w) - D) / n(c) + left(c) p(w | shorter c),   p(w) = (n(w) + 0.5) / (N + 0.5 (V + 1)).

A level has one D = n1 / (n1 + 2 n2), between 0.1 and 0.95, from the numbers of its nodes that were seen once and
twice: the merge writes each shard's nodes and counts, the driver adds up two numbers a shard, and a second pass
over the shard files writes the probabilities beside them.

Shards are ranges of (context, word) of about equal training counts; a context of more than
that is split between shards, and its mass is put together from its parts.
Tasks count the n-grams of a few megabytes of text as sorted arrays and shuffle those, cut by shard, not rows.
All training text is counted, nothing is pruned.  The model lies in files that the
scoring tasks map; they touch the pages that their texts ask for.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text, then one end token.
Null and empty texts are the end token alone.  Word numbers have 32 bits; a larger vocabulary is refused.
With no training text every token is unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest

from snapstrata.llm.elias_fano import EliasFano, encode, map_arrays, nested, within, write_arrays
from snapstrata.llm.shared import Shipped, attempt_name, shared_folder
from snapstrata.llm.texts import blank_separated, coded, pieces, split_words

ORDER = 3
#: no word holds a line break
END_HASH = xxh3_64_intdigest(b"\n")
#: logarithms from the lowest to 0 are kept in 16 bits; 0 stands for none
LOWEST = -12.0
STEPS = 65_534
#: look-ups, and bytes of text, that are worked on at once
LOOKUPS = 1 << 17
TEXT_BYTES = 4 << 20


def word_hashes(words: pa.LargeStringArray) -> np.ndarray:
    """Of the words, and last of the end."""
    return np.array([*map(xxh3_64_intdigest, words.cast(pa.large_binary()).to_pylist()), END_HASH], dtype=np.uint64)


def quantised(log10: np.ndarray) -> np.ndarray:
    return (1 + np.rint((np.clip(log10, LOWEST, 0) - LOWEST) * (STEPS / -LOWEST))).astype("<u2")


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) * (-LOWEST / STEPS) + LOWEST), 0.0)


@dataclass
class Level:
    """Shard s holds the nodes from (contexts[s], words[s]) on; its first node is number bases[s]."""

    contexts: np.ndarray
    words: np.ndarray
    bases: np.ndarray
    files: list[str | None]
    size: int
    #: probabilities of the nodes and mass left by the contexts of each shard
    weights: list[str | None] = field(default_factory=list)
    #: mass that contexts split between shards leave
    left: dict[int, float] = field(default_factory=dict)

    def shard_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        shard = np.searchsorted(self.contexts, context, side="right") - 1
        # unknown words are asked for in a context's first shard
        word = np.maximum(word, 0)
        while True:
            behind = (self.contexts[shard] == context) & (self.words[shard] > word)
            if not behind.any():
                return shard
            shard = shard - behind


@dataclass
class Model:
    """Level 1 (files and bases by the top bits of a hash) and the levels above."""

    bits: int
    files: list[str | None]
    bases: np.ndarray
    vocabulary: int
    tokens: int
    texts: int
    levels: list[Level]

    @property
    def begin(self) -> int:
        """The number of the context before a text."""
        return self.vocabulary


class Reader:
    """Maps the model's files when they are first asked for."""

    def __init__(self, model: Model):
        self.model = model
        self.table = blank_separated()
        self._words: dict[int, dict[str, np.ndarray]] = {}
        self._shards: dict[tuple[int, int], tuple] = {}

    def word_shard(self, shard: int) -> dict[str, np.ndarray]:
        if shard not in self._words:
            self._words[shard] = map_arrays(self.model.files[shard])
        return self._words[shard]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (or -1) and training count of each word."""
        number, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        shards = (sorted_ >> np.uint64(64 - self.model.bits)).astype(np.int64) if self.model.bits else np.zeros(len(order), dtype=np.int64)
        cuts = np.searchsorted(shards, np.arange(len(self.model.files) + 1))
        for shard, (first, last) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if first == last or self.model.files[shard] is None:
                continue
            words = self.word_shard(shard)
            place = np.searchsorted(words["hash"], sorted_[first:last])
            place[place == len(words["hash"])] = 0
            hit = np.flatnonzero(words["hash"][place] == sorted_[first:last])
            rows = order[first:last][hit]
            number[rows] = self.model.bases[shard] + place[hit]
            count[rows] = words["count"][place[hit]]
        return number, count

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word number and count of every token, end tokens included, and the offsets of the texts' tokens."""
        words, ends = split_words(texts, self.table)
        distinct, codes = coded(words)
        number, count = self.numbers(word_hashes(distinct))
        codes = np.insert(codes, ends[1:], len(distinct))
        return number[codes], count[codes], ends + np.arange(len(ends))

    def _shard(self, level: int, shard: int) -> tuple:
        if (level, shard) not in self._shards:
            of = self.model.levels[level]
            arrays, weights = map_arrays(of.files[shard]), map_arrays(of.weights[shard])
            parts = EliasFano(within("pointers", arrays)), EliasFano(within("words", arrays))
            self._shards[level, shard] = (*parts, weights["probability"], weights["left"], int(arrays["first"][0]))
        return self._shards[level, shard]

    def look_up(
        self, level: int, context: np.ndarray, word: np.ndarray, nodes_only: bool = False
    ) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """For contexts and words in any order: node number or -1, discounted probability, and the mass left (-1: no such context).

        nodes_only leaves the last two out: counting a level needs no more of the ones below.
        """
        if nodes_only:
            return self._nodes(level, context, word), None, None
        node, kept, left = np.full(len(context), -1, dtype=np.int64), np.zeros(len(context)), np.full(len(context), -1.0)
        asked = np.flatnonzero(context >= 0)
        if not len(asked) or not self.model.levels[level].size:
            return node, kept, left
        both, back = self._distinct(context[asked], word[asked])
        found = [self._find(level, both[0, at : at + LOOKUPS], both[1, at : at + LOOKUPS]) for at in range(0, both.shape[1], LOOKUPS)]
        for out, parts in zip((node, kept, left), zip(*found)):
            out[asked] = np.concatenate(parts)[back]
        return node, kept, left

    def _nodes(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        # pairs with an unknown part have no node, so they are not looked up
        node = np.full(len(context), -1, dtype=np.int64)
        asked = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(asked) or not self.model.levels[level].size:
            return node
        both, back = self._distinct(context[asked], word[asked])
        found = [self._find(level, *both[:, at : at + LOOKUPS], nodes_only=True)[0] for at in range(0, both.shape[1], LOOKUPS)]
        node[asked] = np.concatenate(found)[back]
        return node

    @staticmethod
    def _distinct(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # word numbers have 32 bits, with the unknown one
        packed = int(context.max()) < 1 << 31
        order = np.argsort(context << 32 | (word + 1)) if packed else np.lexsort((word, context))
        context, word = context[order], word[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.cumsum(new) - 1
        return np.stack([context[new], word[new]]), back

    def _find(
        self, level: int, context: np.ndarray, word: np.ndarray, nodes_only: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted look-ups, shard by shard."""
        of = self.model.levels[level]
        size = 0 if nodes_only else len(context)
        node, kept, left = np.full(len(context), -1, dtype=np.int64), np.zeros(size), np.full(size, -1.0)
        shards = of.shard_of(context, word)
        cuts = np.searchsorted(shards, np.arange(len(of.files) + 1))
        for shard, (first, last) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if first == last or of.files[shard] is None:
                continue
            pointers, words, probability, mass, begin = self._shard(level, shard)
            # the successors' range once for each context
            heads = np.flatnonzero(np.concatenate([[True], np.diff(context[first:last]) != 0]))
            n = np.diff(np.append(heads, last - first))
            own = context[first:last][heads] - begin
            known = (own >= 0) & (own < pointers.n - 1)
            own = np.where(known, own, 0)
            lo, hi = pointers.access(own), pointers.access(own + 1)
            hi = np.where(known, hi, lo)
            base = np.where(lo > 0, words.access(np.maximum(lo - 1, 0)) + 1, 0)
            if not nodes_only:
                codes = np.where(known, mass[own], 0)
                left[first:last] = np.repeat(np.where(codes > 0, restored(codes), -1.0), n)
            wanted = word[first:last]
            hi = np.repeat(hi, n)
            # an unknown word is behind every successor
            place = words.find(np.repeat(base, n) + wanted, np.where(wanted >= 0, np.repeat(lo, n), hi), hi)
            hit = np.flatnonzero(place >= 0)
            node[first + hit] = of.bases[shard] + place[hit]
            if not nodes_only:
                kept[first + hit] = restored(probability[place[hit]])
        if of.left and not nodes_only:
            names = np.array(sorted(of.left), dtype=np.int64)
            place = np.searchsorted(names, context)
            place[place == len(names)] = 0
            split = names[place] == context
            left[split] = np.array([of.left[k] for k in names.tolist()])[place[split]]
        return node, kept, left

    def contexts(self, number: np.ndarray, ends: np.ndarray, upto: int, nodes_only: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level up to ``upto``: (level, context of every token, its node, probability, mass left)."""
        starts = np.zeros(len(number), dtype=bool)
        starts[ends[:-1]] = True
        context = np.empty_like(number)
        context[1:] = number[:-1]
        context[starts] = self.model.begin
        for level in range(upto):
            node, kept, left = self.look_up(level, context, number, nodes_only) if level < len(self.model.levels) else (None, None, None)
            yield level, context, node, kept, left
            if node is None:
                return
            # one level up, the context is the node that ends with the token before
            context = np.empty_like(number)
            context[1:] = node[:-1]
            context[starts] = -1


def _merged(shards: DataFrame, tasks: int, finish: Callable, schema: T.StructType) -> DataFrame:
    """Rows (shard, keys, counts) of sorted arrays, added up per shard; finish(shard, keys, counts) gives a row."""
    kinds = to_arrow_schema(schema)
    dealt = shards.repartition(tasks, "shard").sortWithinPartitions("shard")

    def add(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every, n = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(every, kind="stable")
        every, n = every[order], n[order]
        heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        return every[heads], np.add.reduceat(n, heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, counts, since = None, [], [], 0
        for batch in batches:
            for shard, key, count in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if shard != held and keys:
                    yield pa.RecordBatch.from_pylist([finish(held, *add(keys, counts))], kinds)
                    keys, counts, since = [], [], 0
                held = shard
                keys.append(np.frombuffer(key, dtype="<u8"))
                counts.append(np.frombuffer(count, dtype="<u4").astype(np.int64))
                since += len(keys[-1])
                # equal keys fold together now and then, so that memory follows the distinct ones
                if since > max(1 << 20, len(keys[0])) and len(keys) > 1:
                    folded = add(keys, counts)
                    keys, counts, since = [folded[0]], [folded[1]], 0
        if keys:
            yield pa.RecordBatch.from_pylist([finish(held, *add(keys, counts))], kinds)

    return dealt.mapInArrow(run, schema)


def _cut(shard: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Distinct keys and their counts by shard, as arrays of 64 and 32 bits."""
    order = np.lexsort((keys, shard))
    shard, keys = shard[order], keys[order]
    heads = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])])) if len(keys) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(heads, len(keys)))
    shard, keys = shard[heads], keys[heads]
    firsts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, dtype=np.int64)
    for first, last in zip(firsts.tolist(), [*firsts[1:].tolist(), len(shard)]):
        yield int(shard[first]), keys[first:last].astype("<u8").tobytes(), counts[first:last].astype("<u4").tobytes()


_SHARDS = "shard long, keys binary, counts binary"


def _arrays(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["shard", "keys", "counts"])


def _count_words(texts: DataFrame, folder: str, shards: int) -> Model:
    bits = max(0, (shards - 1).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = blank_separated()
        for piece in pieces(batches, "text"):
            words, _ = split_words(piece.column("text"), table)
            distinct, codes = coded(words)
            hashes = word_hashes(distinct)
            keys = np.append(hashes[codes], np.full(piece.num_rows, END_HASH, dtype=np.uint64))
            shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
            yield _arrays(list(_cut(shard, keys)))

    def finish(shard: int, keys: np.ndarray, counts: np.ndarray) -> dict:
        name = f"{folder}/{attempt_name(f'words-{shard:06d}', '.bin')}"
        write_arrays(name, {"hash": keys, "count": counts})
        ends = counts[keys == np.uint64(END_HASH)]
        return {"shard": shard, "name": name, "n": len(keys), "tokens": int(counts.sum()), "texts": int(ends.sum())}

    counted = texts.mapInArrow(count, _SHARDS)
    # a row per shard
    schema = T.StructType.fromDDL("shard long, name string, n long, tokens long, texts long")
    rows = {r.shard: r for r in _merged(counted, shards, finish, schema).collect()}
    sizes = [rows[s].n if s in rows else 0 for s in range(1 << bits)]
    bases = np.concatenate([[0], np.cumsum(sizes)])
    if bases[-1] >= 1 << 32:
        raise OverflowError("word numbers have 32 bits")
    files = [rows[s].name if s in rows else None for s in range(1 << bits)]
    total = [sum(getattr(r, k) for r in rows.values()) for k in ("tokens", "texts")]
    return Model(bits, files, bases[:-1], int(bases[-1]), *total, [])


def _boundaries(spark: SparkSession, model: Model, shards: int) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """First (context, word) of each shard of the next level, and the counts of the contexts that are split."""
    if model.levels:
        below = model.levels[-1]
        files, bases = below.files, below.bases
    else:
        files, bases = model.files, model.bases
    # what ends a text is the context of nothing
    end = END_HASH if not model.levels else int(Reader(model).numbers(np.array([END_HASH], dtype=np.uint64))[0][0])
    shipped = Shipped(spark, files)

    def weights(k: int) -> np.ndarray:
        arrays = map_arrays(shipped.value[k])
        if "hash" in arrays:
            return np.where(arrays["hash"] == np.uint64(end), 0, arrays["count"])
        return np.where(arrays["last"] == end, 0, arrays["counts"][arrays["code"]])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"k": k, "n": int(weights(k).sum())} for k in batch.column(0).to_pylist()])

    held = [k for k, name in enumerate(files) if name is not None]
    numbered = spark.createDataFrame([(k,) for k in held], "k long").repartition(max(1, len(held)))
    sums = {r.k: r.n for r in numbered.mapInArrow(total, "k long, n long").collect()}
    before, at = {}, 0
    for k in held:
        before[k], at = at, at + sums[k]
    everything = at + (0 if model.levels else model.texts)
    quota = max(1, -(-everything // shards))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"context": -1, "word": 0, "n": 0}]
            for k in batch.column(0).to_pylist():
                weight = weights(k)
                upto = before[k] + np.cumsum(weight)
                wanted = np.arange(before[k] // quota + 1, (before[k] + int(weight.sum())) // quota + 1) * quota
                wanted = wanted[wanted < everything]
                for goal, place in zip(wanted.tolist(), np.searchsorted(upto, wanted).tolist()):
                    n = int(weight[place])
                    inside = goal - (int(upto[place]) - n)
                    word = inside * model.vocabulary // n if 2 * n > quota else 0
                    rows.append({"context": int(bases[k]) + place, "word": word, "n": n if word else 0})
            yield pa.RecordBatch.from_pylist(rows)

    found = {(0, 0)}
    split: dict[int, int] = {}
    for r in numbered.mapInArrow(cut, "context long, word long, n long").collect():
        if r.context >= 0:
            found.add((r.context, r.word))
            if r.n:
                split[r.context] = r.n
    if not model.levels:
        # the context before a text is the last one, with a count per text
        for goal in range(-(-(at + 1) // quota) * quota, everything, quota):
            word = (goal - at) * model.vocabulary // model.texts if 2 * model.texts > quota else 0
            found.add((model.begin, word))
            if word:
                split[model.begin] = model.texts
    order = np.array(sorted(found), dtype=np.int64)
    return order[:, 0], order[:, 1], split


def _add_level(texts: DataFrame, model: Model, folder: str, shards: int, last: bool) -> Level:
    spark = texts.sparkSession
    contexts, words, split = _boundaries(spark, model, shards)
    n_contexts = model.levels[-1].size if model.levels else model.vocabulary + 1
    level = Level(contexts, words, np.zeros(len(contexts), dtype=np.int64), [None] * len(contexts), 0)
    shipped = Shipped(spark, (model, level))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, level = shipped.value
        reader = Reader(model)
        for piece in pieces(batches, "text", TEXT_BYTES):
            number, _, ends = reader.tokens(piece.column("text"))
            context = None
            for _, context, *_ in reader.contexts(number, ends, len(model.levels) + 1, nodes_only=True):
                pass
            known = context >= 0
            context, word = context[known], number[known]
            shard = level.shard_of(context, word)
            keys = (context - level.contexts[shard]).astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
            yield _arrays(list(_cut(shard, keys)))

    def finish(shard: int, keys: np.ndarray, counts: np.ndarray) -> dict:
        first = int(contexts[shard])
        beyond = int(contexts[shard + 1]) + int(words[shard + 1] > 0) if shard + 1 < len(contexts) else n_contexts
        context = (keys >> np.uint64(32)).astype(np.int64)
        word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        tails = np.append(heads[1:], len(context)) - 1
        n_types = tails - heads + 1
        # what each context's successors add to those before
        base = np.concatenate([[0], np.cumsum(word[tails] + 1)])
        rising = word + np.repeat(base[:-1], n_types)
        pointers = np.searchsorted(context, np.arange(beyond - first + 1))
        # few counts differ, so nodes hold their numbers
        distinct, code = np.unique(counts, return_inverse=True)
        arrays = {
            "first": np.array([first], dtype="<i8"),
            **nested("pointers", encode(pointers, len(context))),
            **nested("words", encode(rising, int(rising[-1]))),
            "counts": distinct.astype("<i8"),
            "code": code.astype(np.min_scalar_type(len(distinct))),
        }
        if not last:
            arrays |= {"last": word.astype("<u4")}
        name = f"{folder}/{attempt_name(f'level-{len(model.levels) + 2}-{shard:06d}', '.bin')}"
        write_arrays(name, arrays)
        return {"shard": shard, "name": name, "n": len(keys), "once": int((counts == 1).sum()), "twice": int((counts == 2).sum())}

    counted = texts.mapInArrow(count, _SHARDS)
    schema = T.StructType.fromDDL("shard long, name string, n long, once long, twice long")
    rows = {r.shard: r for r in _merged(counted, shards, finish, schema).collect()}
    sizes = np.array([rows[s].n if s in rows else 0 for s in range(len(contexts))])
    level.bases = np.cumsum(sizes) - sizes
    level.size = int(sizes.sum())
    level.files = [rows[s].name if s in rows else None for s in range(len(contexts))]
    once, twice = (sum(getattr(r, k) for r in rows.values()) for k in ("once", "twice"))
    _add_weights(spark, level, folder, split, min(0.95, max(0.1, once / max(1, once + 2 * twice))))
    return level


def _add_weights(spark: SparkSession, level: Level, folder: str, split: dict[int, int], discount: float) -> None:
    """The second pass over a level's files: probabilities and masses by the one discount, shard by shard."""
    files = level.files

    def weigh(shard: int) -> dict:
        arrays = map_arrays(files[shard])
        first, pointers = int(arrays["first"][0]), EliasFano(within("pointers", arrays))
        bounds = pointers.access(np.arange(pointers.n))
        n_types = np.diff(bounds)
        own = np.flatnonzero(n_types)
        n_types = n_types[own]
        counts = arrays["counts"][arrays["code"]]
        total = np.add.reduceat(counts, bounds[own])
        here = [name for name in split if first <= name < first + pointers.n - 1]
        for name in here:
            total[own == name - first] = split[name]
        mass = discount * n_types / total
        left = np.zeros(pointers.n - 1, dtype="<u2")
        left[own] = quantised(np.log10(mass))
        probability = quantised(np.log10((counts - discount) / np.repeat(total, n_types)))
        name = f"{folder}/{attempt_name(f'weights-{shard:06d}', '.bin')}"
        write_arrays(name, {"probability": probability, "left": left})
        return {"shard": shard, "name": name, "split": here, "left": [float(mass[own == k - first].sum()) for k in here]}

    schema = T.StructType.fromDDL("shard long, name string, split array<long>, left array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([weigh(shard)], to_arrow_schema(schema))

    held = [k for k, name in enumerate(files) if name is not None]
    numbered = spark.createDataFrame([(k,) for k in held], "shard long").repartition(max(1, len(held)))
    level.weights = [None] * len(files)
    # a row per shard
    for r in numbered.mapInArrow(run, schema).collect():
        level.weights[r.shard] = r.name
        for name, part in zip(r.split, r.left):
            level.left[name] = level.left.get(name, 0.0) + part


def train(texts: DataFrame, text: str = "text", order: int = ORDER, folder: str | None = None, shards: int | None = None) -> Model:
    """Count all texts and write the trie's files below a fresh shared folder (or the given one)."""
    spark = texts.sparkSession
    folder = folder or shared_folder(spark, "trie")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    model = _count_words(read, folder, shards)
    for k in range(2, order + 1):
        if model.vocabulary:
            model.levels.append(_add_level(read, model, folder, shards, k == order))
    return model


def score_tokens(reader: Reader, number: np.ndarray, count: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every token by the vocabulary alone and by the model."""
    model = reader.model
    base = (count + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1))
    p = base
    for _, _, _, kept, left in reader.contexts(number, ends, len(model.levels)):
        p = np.where(left >= 0, kept + left * p, p)
    return np.log10(base), np.log10(p)


def score_texts(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all by default), n_tokens, n_known, train_tokens, base_score and score.  Columns of these names are replaced."""
    added = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    read = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*(read.schema[c] for c in kept), *(T.StructField(k, v) for k, v in added.items())])
    shipped = Shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value)
        for piece in pieces(batches, text, TEXT_BYTES):
            number, count, ends = reader.tokens(piece.column(text))
            base, score = score_tokens(reader, number, count, ends)
            starts = ends[:-1]
            new = [
                pa.array(np.diff(ends), pa.int64()),
                pa.array(np.add.reduceat((count > 0).astype(np.int64), starts), pa.int64()),
                pa.array(np.full(len(starts), reader.model.tokens), pa.int64()),
                pa.array(np.add.reduceat(base, starts), pa.float64()),
                pa.array(np.add.reduceat(score, starts), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *new], names=schema.names)

    return read.mapInArrow(run, schema)
