"""Every text query against its SQL, the pipeline against the operators' brute-force versions."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import contamination, fingerprint, groups

import __spark_entry__ as entry
import corpus_pipeline
from snapstrata.llm import piece_lattice, queries, zstd_language

SF = "/root/testdata/sf0.001"
TABLES = sorted(p.stem for p in Path(SF).glob("*.parquet"))


def plain(values):
    return sorted(tuple(str(v) for v in row) for row in values)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert plain(tuple(r[c] for c in columns) for r in frame.collect()) == plain(tuple(r[k] for k in order) for r in want.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding",
    ]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = queries.language_model(spark, SF)
    compressors = model.compressors()
    rows = [r for r in docs.collect() if not zstd_language.judge_text(r.text, compressors, model.narrow)[2]]
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    component = groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    rows = [r for r in rows if component[r.doc_id] == r.doc_id]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not contamination(r.text, items)[4]]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == sorted(r.doc_id for r in rows)
    assert 0 < len(got) < docs.count()
    pieces = piece_lattice.PieceModel.load(public_tokenizers.path(queries.PIECE_MODEL))
    segmenter = piece_lattice.Segmenter(pieces, 1)
    several = piece_lattice.Segmenter(pieces, queries.N_BEST)
    assert all(r.round_trip for r in got.values())
    assert sum(len(r.alternatives) == queries.N_BEST - 1 for r in got.values()) > 0.9 * len(got)
    for r in rows:
        (paths,) = list(several.segment(pa.array([r.text])))
        assert [x.ids for x in got[r.doc_id].alternatives] == [np.frombuffer(ids, dtype="<u4").tolist() for _, ids in paths[1:]]
        assert np.allclose([x.score for x in got[r.doc_id].alternatives], [score for score, _ in paths[1:]])
        (((score, ids),),) = list(segmenter.segment(pa.array([r.text])))
        assert got[r.doc_id].ids == np.frombuffer(ids, dtype="<u4").tolist() and np.isclose(got[r.doc_id].piece_score, score)
        assert (got[r.doc_id].lang, got[r.doc_id].source, got[r.doc_id].n_chars) == (r.lang, r.source, r.n_chars)


def test_stages_return_the_columns_of_documents_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_folds_are_those_of_zlib(spark):
    frame = spark.range(-3, 50).select("id", queries.fold("id").alias("fold"))
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 5 for r in frame.collect())
