from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from snapstrata.llm import token_files
from snapstrata.llm.queries import END_ID, QUERIES, TOKENIZER, VOCABULARY
from snapstrata.llm.texts import pieces

SF = "/root/testdata/sf0.001"
ODD = [
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "é ́x á\nb\x1c\x1dc\xa0d\u2003e \x85f", "ΑΣ ΑΣ. İ I'LL they're 12 3.5",
    "", "  ", "a\x00b", "Straße. œuvre, ÿ;; ÀÉ J̌ x≮ ﬁ ½ ǰ 'S's.", "a'.s b.'s it's. WORD!? ...", None, "ъ,ы. 汉字。 ñandú:", "don.t.", "q.́ x",
    "THE END. the end; The-End", "🙂🙂 ok🙂.",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def test_parts_encode_as_the_library_encodes_whole_texts(spark, tokenizer):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    encoder = token_files.WordEncoder(public_tokenizers.path(TOKENIZER))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    at = 0
    # small pieces: slices of a batch share its buffers
    for piece in pieces(iter([batch]), "text", limit=20_000):
        ids, counts = encoder.encode(piece.column(0), END_ID)
        assert len(ids) == counts.sum()
        ends = np.concatenate([[0], np.cumsum(counts)])
        for k in range(piece.num_rows):
            assert ids[ends[k] : ends[k + 1]].tolist() == whole(tokenizer, texts[at + k])
        at += piece.num_rows
    assert at == len(texts)


def test_query_equals_brute_force(spark, tokenizer):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in QUERIES["op2_token_binary_output"](spark, SF).collect()}
    start = 0
    for d in docs:
        ids = whole(tokenizer, d.text)
        r = got[d.doc_id]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


@pytest.mark.parametrize("vocabulary", [VOCABULARY, 1 << 20])
def test_files_nulls_repeats_and_the_reader(spark, tokenizer, vocabulary):
    rows = [(7, "seven", 1), (None, "nobody's", 2), (-3, None, 3), (7, "seven", 1), (2, "two words", 4), (9, "long " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    ranges = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), END_ID, vocabulary)
    reader = token_files.TokenReader(ranges, vocabulary)
    assert len(reader) == len(rows)
    read = [reader[k] for k in range(len(reader))]
    assert [name for name, _, _ in read] == [None, -3, 2, 7, 7, 9]
    text = {None: "nobody's", -3: None, 2: "two words", 7: "seven", 9: "long " * 50_000}
    start = 0
    for name, at, ids in read:
        assert at == start and ids.tolist() == whole(tokenizer, text[name])
        assert ids.dtype == np.dtype("<u2" if vocabulary == VOCABULARY else "<u4")
        start += len(ids)
    back = token_files.read_token_files(spark, ranges, vocabulary).collect()
    assert sorted(r.start for r in back) == [at for _, at, _ in read]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    ranges = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)
    assert ranges == [] and token_files.read_token_files(spark, ranges, VOCABULARY).count() == 0
