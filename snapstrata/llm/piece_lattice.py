"""SentencePiece encoding and decoding with exact N-best segmentations.

A text becomes a lattice of the model's pieces.  Forward Viterbi scores of every
place serve as the heuristic of an A-star search that runs backward from the
end; as they are exact, complete paths leave its queue in order of their score.

No piece of a model has a blank behind another character, so the lattice of a
text falls apart at blanks (and at control characters that occur in no longer
piece) into chunks.  Each distinct chunk is searched once, and a second search of the same kind over the chunks' alternatives, by what each
loses against its best, merges them to the best segmentations of the whole text.

Scores are those of the model's pieces, added up.  A character without a piece
costs ten more than the lowest regular piece and is written as its bytes.  Null
and empty texts have no pieces, one segmentation, and score 0.  Texts are decoded
to what was encoded, but for the character U+2581, which stands for a blank.
Ties of segmentations are ordered the same way on every run.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapstrata.llm.shared import Shipped
from snapstrata.llm.texts import as_large_strings, pieces

BLANK = "▁"
#: scores at or below this mark pieces that are no part of regular scoring (runs of blanks)
IRREGULAR = -1e8


@dataclass(frozen=True)
class PieceModel:
    """Pieces by text, with plain blanks: (id, score), and (-1, 0) for texts that only start a piece.

    decoded holds what each id stands for, alone the control characters that occur in no longer piece.
    """

    table: dict[str, tuple[int, float]]
    decoded: list[bytes]
    byte_ids: list[int]
    unknown_id: int
    unknown_score: float
    alone: bytes

    @staticmethod
    def from_pieces(found: list[tuple[int, str, float]], byte_ids: list[int], unknown_id: int, size: int) -> PieceModel:
        table: dict[str, tuple[int, float]] = {}
        decoded = [b""] * size
        for i, piece, score in found:
            plain = piece.replace(BLANK, " ")
            if " " in plain.lstrip(" "):
                raise ValueError(f"piece {piece!r} has a blank behind another character")
            table[plain] = (i, score)
            decoded[i] = plain.encode()
            for end in range(1, len(plain)):
                table.setdefault(plain[:end], (-1, 0.0))
        for byte, i in enumerate(byte_ids):
            decoded[i] = bytes([byte])
        regular = [score for _, _, score in found if score > IRREGULAR]
        joined = {c for _, piece, _ in found if len(piece) > 1 for c in piece}
        alone = bytes(c for c in range(32) if chr(c) not in joined)
        return PieceModel(table, decoded, byte_ids, unknown_id, min(regular, default=0.0) - 10, alone)

    @staticmethod
    def load(path: str) -> PieceModel:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        byte_ids = [i for i in ids if model.is_byte(i)]
        found = [(i, model.id_to_piece(i), model.get_score(i)) for i in ids if i not in special and not model.is_byte(i)]
        return PieceModel.from_pieces(found, byte_ids, model.unk_id(), len(ids))

    def unknown(self, char: str) -> tuple[int, ...]:
        if not self.byte_ids:
            return (self.unknown_id,)
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


class Trie:
    """The pieces as arrays: from (node, character) to the next node, which may hold a piece."""

    def __init__(self, table: dict[str, tuple[int, float]]):
        nodes = {text: k + 1 for k, text in enumerate(table)}
        nodes[""] = 0
        steps = sorted((nodes[text[:-1]] << 21 | ord(text[-1]), nodes[text]) for text in table)
        self.keys = np.array([k for k, _ in steps] or [-1], dtype=np.int64)
        self.next = np.array([v for _, v in steps] or [0], dtype=np.int64)
        self.piece = np.array([-1, *(i for i, _ in table.values())], dtype=np.int64)
        self.score = np.array([0.0, *(score for _, score in table.values())])

    def step(self, node: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of them go on, and where those arrive."""
        key = node << 21 | char
        place = np.searchsorted(self.keys, key)
        place[place == len(self.keys)] = 0
        going = np.flatnonzero(self.keys[place] == key)
        return going, self.next[place[going]]


class Segmenter:
    """Searches the lattices of chunks."""

    def __init__(self, model: PieceModel, n_best: int):
        self.model, self.n_best = model, n_best
        self.trie = Trie(model.table)
        self.alone = np.zeros(256, dtype=bool)
        self.alone[np.frombuffer(model.alone, dtype=np.uint8)] = True
        self.more: dict[str, list[tuple[float, bytes]]] = {}
        self.decoded = pa.array(model.decoded, pa.large_binary())

    def viterbi(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of each chunk: the best score, what the second-best path loses against it, the best path's ids.

        Chunks of equal length go forward together, a character at a time.
        """
        scores, losses = np.zeros(len(chunks)), np.zeros(len(chunks))
        paths: list[bytes] = [b""] * len(chunks)
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        order = np.argsort(sizes, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if not len(same):
                continue
            n = int(sizes[same[0]])
            text = "".join([chunks[k] for k in same.tolist()]).encode("utf-32-le", "surrogatepass")
            chars = np.frombuffer(text, dtype="<u4").reshape(len(same), n).T.astype(np.int64)
            first, second, begin, piece = self._forward(chars)
            scores[same], losses[same] = first[n], first[n] - second[n]
            for k, path in zip(same.tolist(), self._backtrack(begin, piece, [chunks[k] for k in same.tolist()])):
                paths[k] = path
        return scores, losses, paths

    def _forward(self, chars: np.ndarray):
        """Two best scores of every place, and the last piece of the best path to it."""
        n, many = chars.shape
        low = float("-inf")
        first, second = np.full((n + 1, many), low), np.full((n + 1, many), low)
        begin, last = np.zeros((n + 1, many), dtype=np.int64), np.zeros((n + 1, many), dtype=np.int64)
        first[0] = 0.0

        def reach(rows, i, j, piece, score):
            ahead, behind = first[i, rows] + score, second[i, rows] + score
            had, had_second = first[j, rows], second[j, rows]
            better = ahead > had
            second[j, rows] = np.where(better, np.maximum(had, behind), np.maximum(had_second, ahead))
            first[j, rows] = np.maximum(had, ahead)
            begin[j, rows[better]] = i
            last[j, rows[better]] = piece[better]

        for i in range(n):
            rows, node = np.arange(many), np.zeros(many, dtype=np.int64)
            single = np.zeros(many, dtype=bool)
            for j in range(i + 1, n + 1):
                going, node = self.trie.step(node, chars[j - 1, rows])
                rows = rows[going]
                if not len(rows):
                    break
                piece = self.trie.piece[node]
                full = np.flatnonzero(piece >= 0)
                if len(full):
                    reach(rows[full], i, j, piece[full], self.trie.score[node[full]])
                    if j == i + 1:
                        single[rows[full]] = True
            if not single.all():
                rows = np.flatnonzero(~single)
                reach(rows, i, i + 1, np.full(len(rows), -1), self.model.unknown_score)
        return first, second, begin, last

    def _backtrack(self, begin: np.ndarray, last: np.ndarray, chunks: list[str]) -> list[bytes]:
        many = begin.shape[1]
        at, rows = np.full(many, begin.shape[0] - 1), np.arange(many)
        steps = []
        while True:
            open_ = at > 0
            if not open_.any():
                break
            steps.append(np.where(open_, last[at, rows], -2))
            at = np.where(open_, begin[at, rows], 0)
        path = np.array(steps[::-1]).T
        taken = path != -2
        flat, ends = path[taken], np.concatenate([[0], np.cumsum(taken.sum(axis=1))])
        data = flat.astype("<u4").tobytes()
        strange = set(np.flatnonzero((path == -1).any(axis=1)).tolist())
        bounds = (4 * ends).tolist()
        out = [data[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
        for k in strange:
            ids, place = [], 0
            for piece in flat[ends[k] : ends[k + 1]].tolist():
                if piece >= 0:
                    ids.append(piece)
                    place += len(self.model.decoded[piece].decode())
                else:
                    ids.extend(self.model.unknown(chunks[k][place]))
                    place += 1
            out[k] = _packed(ids)
        return out

    def search(self, chunk: str) -> list[tuple[float, bytes]]:
        """Up to n_best paths of a chunk by A-star from its end, best first."""
        table, unknown, n = self.model.table, self.model.unknown_score, len(chunk)
        forward = [float("-inf")] * (n + 1)
        forward[0] = 0.0
        edges: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            single = False
            for j in range(i + 1, n + 1):
                piece = table.get(chunk[i:j])
                if piece is None:
                    break
                if piece[0] >= 0:
                    single |= j == i + 1
                    edges[j].append((i, piece[1], (piece[0],)))
                    forward[j] = max(forward[j], forward[i] + piece[1])
            if not single:
                edges[i + 1].append((i, unknown, self.model.unknown(chunk[i])))
                forward[i + 1] = max(forward[i + 1], forward[i] + unknown)
        found: list[tuple[float, bytes]] = []
        count = 0
        queue: list[tuple] = [(-forward[n], 0, n, 0.0, None)]
        while queue and len(found) < self.n_best:
            _, _, at, done, path = heapq.heappop(queue)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                found.append((done, _packed(ids)))
                continue
            for i, score, ids in edges[at]:
                count += 1
                heapq.heappush(queue, (-(done + score + forward[i]), count, i, done + score, (ids, path)))
        return found

    def chunks(self, texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The chunks of all texts, each with the blanks before it, and the offsets of each text's chunks.

        A blank is put before every text that isn't empty, as the model's dummy prefix.
        """
        plain = pc.replace_substring(as_large_strings(texts), BLANK, " ")
        filled = pc.greater(pc.binary_length(plain), 0)
        sizes = np.zeros(len(texts) + 1, dtype=np.int64)
        kept = plain.filter(filled)
        if not len(kept):
            return pa.array([], pa.large_string()), sizes
        blank = pa.scalar(" ", pa.large_string())
        spaced = pc.binary_join_element_wise(blank, kept, pa.scalar("", pa.large_string()))
        _, places, data = spaced.buffers()
        places, raw = np.frombuffer(places, dtype=np.int64)[: len(kept) + 1], np.frombuffer(data, dtype=np.uint8)
        raw = raw[: places[-1]]
        blanks, alone = raw == 0x20, self.alone[raw]
        starts = alone.copy()
        starts[1:] |= (blanks[1:] & ~blanks[:-1]) | alone[:-1]
        starts[places[:-1]] = True
        ends = np.append(np.flatnonzero(starts), len(raw))
        chunks = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), data)
        sizes[1:][filled.to_numpy(zero_copy_only=False)] = np.diff(np.searchsorted(ends, places))
        return chunks, np.cumsum(sizes)

    def segment(self, texts: pa.Array) -> Iterator[list[tuple[float, bytes]]]:
        """For each text its best segmentations as (score, ids as little-endian 32-bit integers)."""
        chunks, ends = self.chunks(texts)
        encoded = chunks.dictionary_encode()
        codes, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()
        score, loss, paths = self.viterbi(distinct)
        joined = pa.array(paths, pa.large_binary()).take(pa.array(codes))
        _, places, data = joined.buffers()
        bounds = np.frombuffer(places, dtype=np.int64) if places is not None else np.zeros(1, dtype=np.int64)
        data = memoryview(data) if data is not None else memoryview(b"")

        def alternatives(code: int) -> list[tuple[float, bytes]]:
            """(loss, ids) of a chunk's paths; the first is Viterbi's, with loss 0."""
            chunk = distinct[code]
            if chunk not in self.more:
                best = float(score[code])
                rest = [(best - s, ids) for s, ids in self.search(chunk) if ids != paths[code]]
                self.more[chunk] = [(0.0, paths[code]), *rest[: self.n_best - 1]]
            return self.more[chunk]

        bounds = bounds.tolist() if len(codes) else [0]
        ends = ends.tolist()
        for first, last in zip(ends[:-1], ends[1:]):
            own = codes[first:last]
            if not len(own):
                yield [(0.0, b"")]
                continue
            total = float(score[own].sum())
            out = [(total, bytes(data[bounds[first] : bounds[last]]))]
            for lost, changes in self._merged(own, loss[own], alternatives):
                parts, at = [], bounds[first]
                for place, ids in changes:
                    parts += [data[at : bounds[first + place]], ids]
                    at = bounds[first + place + 1]
                out.append((total - lost, b"".join([*parts, data[at : bounds[last]]])))
            yield out

    def _merged(self, own: np.ndarray, loss: np.ndarray, alternatives) -> Iterator[tuple[float, list[tuple[int, bytes]]]]:
        """The losses and changed chunks of all segmentations but the best.

        A segmentation among the n best changes none but the n - 1 chunks that lose least.
        """
        n = self.n_best - 1
        if n < 1:
            return
        if len(loss) > n:
            limit = np.partition(loss, n - 1)[n - 1]
            places = np.concatenate([np.flatnonzero(loss < limit), np.flatnonzero(loss == limit)])[:n]
        else:
            places = np.arange(len(loss))
        places = sorted(p for p in places.tolist() if loss[p] != float("inf"))
        lists = [alternatives(int(own[p])) for p in places]
        queue: list[tuple[float, tuple[int, ...], int]] = [(0.0, (0,) * len(lists), 0)]
        given = -1
        while queue and given < n:
            lost, choice, start = heapq.heappop(queue)
            if given >= 0:
                yield lost, [(places[k], lists[k][c][1]) for k, c in enumerate(choice) if c]
            given += 1
            for k in range(start, len(lists)):
                if choice[k] + 1 < len(lists[k]):
                    further = lost - lists[k][choice[k]][0] + lists[k][choice[k] + 1][0]
                    heapq.heappush(queue, (further, (*choice[:k], choice[k] + 1, *choice[k + 1 :]), k))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The texts of encoded ids, as UTF-8."""
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
        joined = self.decoded.take(pa.array(flat))
        _, places, data = joined.buffers()
        if data is None:
            return [b""] * len(ids)
        cuts = np.frombuffer(places, dtype=np.int64)[ends].tolist()
        data = memoryview(data)
        return [bytes(data[x + 1 if data[x : x + 1] == b" " else x : y]) for x, y in zip(cuts[:-1], cuts[1:])]


def _rows(docs: DataFrame, model: PieceModel, text: str, n_best: int, kept: list[str], added: T.StructType, columns):
    """The kept columns and what columns() makes of a text and its segmentations."""
    read = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*(read.schema[c] for c in kept), *added])
    shared = Shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value, n_best)
        for piece in pieces(batches, text):
            texts = piece.column(text)
            new = columns(segmenter, texts, segmenter.segment(texts))
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *new], names=[*kept, *added.names])

    return read.mapInArrow(run, schema)


def _decodes(segmenter: Segmenter, texts: pa.Array, best: list[bytes]) -> pa.Array:
    """Whether the ids spell the texts again; null where a text is."""
    plain = pc.replace_substring(as_large_strings(texts), BLANK, " ").cast(pa.large_binary())
    return pc.equal(pa.array(segmenter.decode(best), pa.large_binary()), plain)


def encode(docs: DataFrame, model: PieceModel, text: str = "text", n_best: int = 1, keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """The columns in keep (all by default), and segmentations: array of (score, ids), best first.

    With decoded also round_trip: the best one decodes to the text (null for a null text).
    """
    row = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    added = T.StructType([T.StructField("segmentations", T.ArrayType(row)), *([T.StructField("round_trip", T.BooleanType())] if decoded else [])])
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added.names]

    def columns(segmenter: Segmenter, texts: pa.Array, found) -> list[pa.Array]:
        scores, flat, ends, outer, best = [], [], [0], [0], []
        for paths in found:
            best.append(paths[0][1])
            for score, ids in paths:
                scores.append(score)
                flat.append(ids)
                ends.append(ends[-1] + len(ids) // 4)
            outer.append(len(scores))
        values = pa.array(np.frombuffer(b"".join(flat), dtype="<i4"), pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        structs = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), lists], names=["score", "ids"])
        lists = pa.ListArray.from_arrays(pa.array(outer, pa.int32()), structs)
        return [lists, _decodes(segmenter, texts, best)] if decoded else [lists]

    return _rows(docs, model, text, n_best, kept, added, columns)


def decode(encoded: DataFrame, model: PieceModel, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns and the text of an array of ids; a null array is a null text.  A column of that name is replaced."""
    kept = [c for c in encoded.columns if c != text]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(text, T.StringType())])
    shared = Shipped(encoded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value, 1)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = segmenter.decode([_packed(x or []) for x in lists])
            spoken = [None if x is None else y.decode("utf-8", "surrogatepass") for x, y in zip(lists, texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(spoken, pa.string())], names=[*kept, text])

    return encoded.select(*encoded.columns).mapInArrow(run, schema)


def encode_summary(docs: DataFrame, model: PieceModel, text: str = "text", n_best: int = 1, keep: list[str] | None = None) -> DataFrame:
    """The columns in keep, and what identifies each text's segmentations without holding their ids.

    n_pieces and ids_crc32 of the best one; scores and crc32s of all, best first (crc32 of the ids as
    little-endian 32-bit integers); round_trip: the best one decodes to the text (all spell the same characters).
    """
    added = T.StructType(
        [
            T.StructField("n_pieces", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("scores", T.ArrayType(T.DoubleType())),
            T.StructField("crc32s", T.ArrayType(T.LongType())),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added.names]

    def columns(segmenter: Segmenter, texts: pa.Array, found) -> list[pa.Array]:
        rows, best = [], []
        for paths in found:
            crcs = [zlib.crc32(ids) for _, ids in paths]
            rows.append((len(paths[0][1]) // 4, crcs[0], [s for s, _ in paths], crcs))
            best.append(paths[0][1])
        same = _decodes(segmenter, texts, best)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
        return [*(pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)), same]

    return _rows(docs, model, text, n_best, kept, added, columns)
