"""Language identification by compression.

Each language gets a zstandard raw-content dictionary: the words that are
most frequent in a bounded sample of its labelled texts, the most frequent ones
last, where offsets are shortest.  A text is encoded as a whole with every dictionary
and gets the language of the smallest frame.  A prediction is rejected when the
runner-up's frame is no more than a narrow margin larger.  How narrow is learned: a fifth of the sampled
texts goes into no dictionary, and the margin is half of what nearly all of these that are
identified rightly reach, so that texts as clear as these stay.

Null texts and texts without a letter are ``und`` with score 0 and are rejected.
Ties go to the smaller language name and are rejected.  Very long texts are
encoded whole.  With an empty model every text is ``und``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.texts import coded, pieces, split_words

#: documented bounds of what is learned: labelled texts per language, and bytes of each dictionary
SAMPLE_TEXTS = 3000
DICTIONARY_BYTES = 64 << 10
#: a margin below a share of the runner-up's frame, or below one byte, is narrow; bounds of the share that is learned
NARROW, WIDEST = 0.001, 0.02
#: one sampled text of so many is set aside for the margin, and the part of them that may fall short of twice the margin
SET_ASIDE, SHORT_OF = 5, 0.001
#: every text is encoded as so many copies of it: alone, frames of a few words would
#: be stored raw and have the same size for every language
COPIES = 4
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Raw-content dictionaries by language, in order of names."""

    contents: tuple[tuple[str, bytes], ...]
    #: the narrow margin, as a share of the runner-up's frame
    narrow: float = NARROW

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        params = zstandard.ZstdCompressionParameters(
            window_log=20, chain_log=16, hash_log=17, search_log=3, min_match=3, target_length=8,
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        return [
            (
                name,
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                    compression_params=params,
                ),
            )
            for name, content in self.contents
        ]


def _plain_blanks() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[9:14] = 0x20
    return table


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES,
) -> LanguageModel:
    """Dictionaries from about sample_texts texts per language, chosen by a hash of their key.

    Rows without a text, language or key teach nothing.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return LanguageModel(())
    scale = 1 << 20
    share = F.lit(None).cast("long")
    for name, n in counts.items():
        share = F.when(F.col(lang) == name, math.ceil(scale * min(1, sample_texts / n))).otherwise(share)
    aside = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(SET_ASIDE)) == 0
    sampled = rows.where(F.pmod(F.xxhash64(key), F.lit(scale)) < share).select(
        F.col(lang).alias("lang"), F.lower(text).alias("text"), aside.alias("aside")
    )
    chosen = sampled.where("NOT aside")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _plain_blanks()
        for piece in pieces(batches, "text"):
            words, ends = split_words(piece.column("text"), table)
            distinct, place = coded(words)
            names = pc.dictionary_encode(piece.column("lang"))
            owner = np.repeat(names.indices.to_numpy(), np.diff(ends))
            both, n = np.unique(owner * max(1, len(distinct)) + place, return_counts=True)
            which, word = np.divmod(both, max(1, len(distinct)))
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(which)).cast(pa.string()), distinct.take(pa.array(word)).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "word", "n"],
            )

    most = dictionary_bytes // 2
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        chosen.mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    )
    by_lang: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for row in top.orderBy("lang", "place").select("lang", "word").collect():
        word = row.word.encode()
        if size.get(row.lang, 0) + len(word) + 1 <= dictionary_bytes:
            size[row.lang] = size.get(row.lang, 0) + len(word) + 1
            by_lang.setdefault(row.lang, []).append(word)
    # zstandard takes contents of eight bytes and more
    model = LanguageModel(tuple((k, b" ".join(reversed(v)).rjust(8)) for k, v in sorted(by_lang.items())))
    return replace(model, narrow=learned_margin(sampled.where("aside"), model))


def learned_margin(sampled: DataFrame, model: LanguageModel) -> float:
    """Half the margin that all but SHORT_OF of the rightly identified texts reach, within its bounds."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for piece in pieces(batches, "text"):
            margins = []
            for text, lang in zip(piece.column("text").to_pylist(), piece.column("lang").to_pylist()):
                if any(map(str.isalpha, text)):
                    name, sizes = frames(text, compressors)
                    first, second = sorted(sizes)[:2]
                    if name == lang:
                        margins.append((second - first) / second)
            yield pa.RecordBatch.from_arrays([pa.array(margins, pa.float64())], names=["margin"])

    if len(model.contents) < 2:
        return NARROW
    reached = sampled.mapInArrow(measure, "margin double").agg(F.percentile("margin", SHORT_OF)).first()[0]
    return min(WIDEST, max(NARROW, (reached or 0.0) / 2))


def frames(text: str, compressors) -> tuple[str, list[int]]:
    """The language of the smallest frame, and all frames' sizes."""
    data = text.lower().encode("utf-8", "surrogatepass")
    data = b"\n".join([data] * COPIES)
    sizes = [len(compressor.compress(data)) for _, compressor in compressors]
    return compressors[sizes.index(min(sizes))][0], sizes


def judge_text(text: str | None, compressors, narrow: float) -> tuple[str, float, bool]:
    if text is None or not compressors or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    name, sizes = frames(text, compressors)
    best = min(sizes)
    score = 1.0 / sum(math.exp((best - size) / (1 + best / 100)) for size in sizes)
    rest = sorted(sizes)[1:2]
    margin = (rest[0] - best) if rest else best
    rejected = margin < 1 or bool(rest) and margin < narrow * rest[0]
    return name, score, rejected


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", narrow: float | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all by default) with lang_pred, score and lang_rejected.  Columns of these names are replaced.

    narrow is the model's unless given.
    """
    narrow = model.narrow if narrow is None else narrow
    added = ("lang_pred", "score", "lang_rejected")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    read = docs.select(*dict.fromkeys([*kept, text]))
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*(read.schema[c] for c in kept), *(T.StructField(n, k) for n, k in zip(added, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for piece in pieces(batches, text):
            rows = [judge_text(x, compressors, narrow) for x in piece.column(text).to_pylist()]
            names, scores, rejected = zip(*rows)
            new = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *new], names=[*kept, *added])

    return read.mapInArrow(run, schema)


def reject_unclear(docs: DataFrame, model: LanguageModel, text: str = "text", narrow: float | None = None) -> DataFrame:
    """docs without the texts whose language stays unclear; narrow is the model's unless given."""
    narrow = model.narrow if narrow is None else narrow
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for piece in pieces(batches, text):
            keep = [not judge_text(x, compressors, narrow)[2] for x in piece.column(text).to_pylist()]
            yield piece.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
