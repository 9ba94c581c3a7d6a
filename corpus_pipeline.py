"""Documents to encoded training text, in stages that are each written and read again.

Language identification drops texts whose language stays unclear; of each group of
near-duplicates by SimHash one document stays; documents that hold benchmark passages go;
what is left is encoded with SentencePiece, its N best segmentations, and decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import decontamination, piece_lattice, simhash_dedup, zstd_language
from snapstrata.llm.queries import N_BEST, PIECE_MODEL, language_model, table
from snapstrata.llm.shared import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return zstd_language.reject_unclear(docs, language_model(spark, sf_dir))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_duplicates(docs, shingle=3, max_distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ids and score of the best segmentation, the alternatives, and whether the ids decode to the text again."""
    model = piece_lattice.PieceModel.load(public_tokenizers.path(PIECE_MODEL))
    encoded = piece_lattice.encode(docs, model, n_best=N_BEST, keep=[c for c in docs.columns if c != "text"], decoded=True)
    best = F.get("segmentations", F.lit(0))
    return encoded.select(
        *[c for c in encoded.columns if c not in ("segmentations", "round_trip")],
        best["ids"].alias("ids"), best["score"].alias("piece_score"),
        F.slice("segmentations", 2, N_BEST).alias("alternatives"), "round_trip",
    )


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: compression, fingerprints and segmentations are beyond SQL; tests compare run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
