from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from snapstrata.llm import zstd_language
from snapstrata.llm.queries import QUERIES, language_model

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_compression_language_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.95
    assert sum(r.lang_rejected for r in rows) / len(rows) < 0.02


def test_the_learned_margin_rejects_mixed_texts_and_keeps_clean_ones(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and r.lang]
    model = language_model(spark, SF)
    assert zstd_language.NARROW < model.narrow <= zstd_language.WIDEST
    compressors = model.compressors()
    held = sorted((r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 5 == 0), key=lambda r: r.doc_id)
    clean = [zstd_language.judge_text(r.text, compressors, model.narrow)[2] for r in held]
    assert sum(clean) <= 0.006 * len(clean)
    mixed = []
    for one, other in zip(held, held[1:]):
        if one.lang != other.lang:
            n = min(len(one.text), len(other.text))
            mixed.append(zstd_language.judge_text(f"{one.text[:n]} {other.text[:n]}", compressors, model.narrow)[2])
    assert len(mixed) > 50 and sum(mixed) >= 0.15 * len(mixed)


def small(spark):
    rows = [(k, "the dreaming cat watches another dog of this painted house", "en") for k in range(20)]
    rows += [(k, "der schlafende hund betrachtet die katze von diesem garten", "de") for k in range(20, 40)]
    rows += [(50, None, "en"), (51, "kein", None), (None, "nothing", "xx")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_edges(spark):
    model = zstd_language.learn(small(spark))
    assert [name for name, _ in model.contents] == ["de", "en"]
    rows = [(1, "another painted house, dreaming", 1), (2, "Die schlafende Katze betrachtet", 2), (3, None, 3), (4, "", 4), (5, "123 !? 45", 5), (6, "the dreaming dog " * 100_000, 6), (6, "another house dreaming", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = [(r.doc_id, r.lang_pred, r.lang_rejected) for r in zstd_language.identify(docs, model).collect()]
    assert got[:5] == [(1, "en", False), (2, "de", False), (3, "und", True), (4, "und", True), (5, "und", True)]
    assert [g[1] for g in got[5:]] == ["en", "en"]
    kept = zstd_language.reject_unclear(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6}


def test_a_tie_goes_to_the_smaller_name_and_is_rejected(spark):
    model = zstd_language.LanguageModel((("aa", b"same words"), ("bb", b"same words")))
    docs = spark.createDataFrame([("same words",)], "text string")
    (row,) = zstd_language.identify(docs, model).collect()
    assert (row.lang_pred, row.lang_rejected) == ("aa", True)


def test_empty_tables(spark):
    empty = small(spark).limit(0)
    model = zstd_language.learn(empty)
    assert model.contents == ()
    (row,) = zstd_language.identify(spark.createDataFrame([("text",)], "text string"), model).collect()
    assert row.lang_pred == "und"
    assert zstd_language.identify(empty, model).count() == 0


def test_the_sample_is_bounded(spark):
    many = small(spark).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30)))).withColumn("doc_id", F.col("doc_id") * 100 + F.col("n"))
    model = zstd_language.learn(many, sample_texts=10, dictionary_bytes=64)
    assert all(len(content) <= 64 for _, content in model.contents) and len(model.contents) == 2
