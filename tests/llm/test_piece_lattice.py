from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from snapstrata.llm import piece_lattice
from snapstrata.llm.piece_lattice import BLANK, PieceModel, Segmenter
from snapstrata.llm.queries import N_BEST, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"


def small_model(byte_fallback: bool = True) -> PieceModel:
    texts = ["a", "b", "c", "ab", "abc", "bc", "▁", "▁a", "▁ab", "cab", "▁▁", "é"]
    rng = random.Random(2)
    found = [(k + 257, t, -float(rng.randint(1, 40)) / 4) for k, t in enumerate(texts)]
    return PieceModel.from_pieces(found, list(range(1, 257)) if byte_fallback else [], 0, 300)


def every_path(model: PieceModel, text: str):
    """All segmentations of a text, by plain recursion."""
    plain = " " + text.replace(BLANK, " ") if text else ""

    def paths(at):
        if at == len(plain):
            yield 0.0, []
            return
        single = plain[at] in model.table and model.table[plain[at]][0] >= 0
        steps = [(at + 1, model.unknown_score, list(model.unknown(plain[at])))] if not single else []
        for end in range(at + 1, len(plain) + 1):
            piece = model.table.get(plain[at:end])
            if piece and piece[0] >= 0:
                steps.append((end, piece[1], [piece[0]]))
        for end, score, ids in steps:
            for rest, more in paths(end):
                yield score + rest, ids + more

    return list(paths(0))


@pytest.mark.parametrize("n_best", [1, 2, 5, 40])
def test_n_best_equals_all_paths(n_best):
    model = small_model()
    rng = random.Random(4)
    texts = ["", None, "a", "abcab", "  ab  cab ", "a\nb", "éz▁ab", "zz"] + ["".join(rng.choice("abc z") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    segmenter = Segmenter(model, n_best)
    for text, found in zip(texts, segmenter.segment(pa.array(texts))):
        paths = every_path(model, text or "")
        want = sorted((s for s, _ in paths), reverse=True)[:n_best]
        assert np.allclose([s for s, _ in found], want)
        known = {tuple(ids): s for s, ids in paths}
        got = [tuple(np.frombuffer(ids, dtype="<u4").tolist()) for _, ids in found]
        assert len(set(got)) == len(got)
        assert all(np.isclose(known[ids], s) for ids, (s, _) in zip(got, found))
        assert {x.decode() for x in segmenter.decode([ids for _, ids in found])} == {(text or "").replace(BLANK, " ")}


def test_without_byte_pieces_an_unknown_character_is_one_id():
    model = small_model(byte_fallback=False)
    ((_, ids),) = next(Segmenter(model, 1).segment(pa.array(["z"])))
    assert np.frombuffer(ids, dtype="<u4").tolist()[-1] == 0


def test_equals_the_library_on_the_public_model():
    path = public_tokenizers.path(PIECE_MODEL)
    model = PieceModel.load(path)
    raw = open(path, "rb").read()
    kind = raw.rindex(b"\x18\x02 \x80\xfa\x01")
    # the library searches its lattices for unigram models; scores and pieces stay the same
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[:kind] + b"\x18\x01" + raw[kind + 2 :])
    texts = ["Hello world", "the theation of anoring", "einkommen über alles", "segmentation"]
    for text, found in zip(texts, Segmenter(model, 6).segment(pa.array(texts))):
        ways = library.nbest_encode_as_pieces(text, 6)
        scores = [sum(model.table[p.replace(BLANK, " ")][1] for p in way) for way in ways]
        assert [s for s, _ in found] == scores


def test_query_over_the_documents(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_sentencepiece_nbest"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs) and all(r.round_trip for r in rows.values())
    model = PieceModel.load(public_tokenizers.path(PIECE_MODEL))
    for d in docs[:40]:
        found = next(Segmenter(model, N_BEST).segment(pa.array([d.text])))
        r = rows[d.doc_id]
        assert r.crc32s == [zlib.crc32(ids) for _, ids in found]
        assert np.allclose(r.scores, [s for s, _ in found]) and r.scores == sorted(r.scores, reverse=True)
        assert r.n_pieces == len(found[0][1]) // 4


def test_encode_and_decode_round_trip(spark):
    model = small_model()
    rows = [(1, "ab cab", 7), (1, "ab cab", 7), (2, None, 8), (3, "", 9), (4, " a  é\tz" * 2000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    encoded = piece_lattice.encode(docs, model, n_best=2).selectExpr("doc_id", "text AS original", "get(segmentations, 0).ids AS ids")
    for r in piece_lattice.decode(encoded, model).collect():
        assert r.text == (r.original or "")
    assert piece_lattice.encode(docs.limit(0), model).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert piece_lattice.decode(nothing, model).collect()[0].text is None
