from __future__ import annotations

import random

import numpy as np
import pytest

from snapstrata.llm import window_dedup
from snapstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plainly(rows, window):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text), by plain loops over word tuples."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in QUERIES["op11_substring_dedup"](spark, SF).collect()}
    assert got == {i: (n, gone) for i, n, gone, _ in plainly(rows, 13)}
    assert 0 < sum(gone for _, gone in got.values())


@pytest.mark.parametrize("window", [1, 2, 3, 5, 13])
def test_windows_of_any_length_over_many_cells_and_partitions(spark, window):
    rng = random.Random(window)
    passage = [f"w{rng.randrange(9)}" for _ in range(40)]
    rows = []
    for i in rng.sample(range(-40, 300), 60):
        text = [rng.choice("abcdefgh") for _ in range(rng.randrange(40))]
        at = rng.randrange(25)
        rows.append((i, rng.choice([" ", "\t", " \n"]).join(text[:9] + passage[at : at + rng.randrange(16)] + text[9:])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for cells in (1, 7):
        assert result(window_dedup.remove_repeated_windows(frame, window, cells=cells)) == plainly(rows, window)


def test_hot_passage_long_text_and_repeats_inside_a_text(spark):
    shared = " ".join(f"p{k}" for k in range(30))
    rows = [(k, f"own{k} {shared} end{k}") for k in range(200)]
    rows += [(900, "again " * 20_000), (901, "again " * 20_000 + "last"), (902, "a b c " * 500), (903, "x" * 100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(window_dedup.remove_repeated_windows(frame, 13, cells=4)) == plainly(rows, 13)


def test_nulls_blanks_repeated_ids_and_rows(spark):
    text = " ".join(f"t{k}" for k in range(20))
    other = " ".join(f"s{k}" for k in range(20))
    rows = [(None, text), (None, other), (3, None), (4, ""), (5, " \t\x0b\n"), (6, text), (6, text), (6, "new " + text), (6, other)]
    rows += [(7, text + " "), (7, "x " + other), (8, "a b c"), (9, "a b c"), (5, other), (-2, "é é " * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = result(window_dedup.remove_repeated_windows(frame, 13, cells=3))
    assert got == plainly(rows, 13)
    assert (None, 20, 0, text) in got and (6, 20, 0, text) in got and (6, 20, 20, "") in got


def test_empty_tables_and_clashing_names(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert window_dedup.remove_repeated_windows(frame).collect() == []
    rows = [(1, "a b c", 7, "x", 1.5), (2, "q a b c", 8, "y", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words long, body string, cell double")
    out = window_dedup.remove_repeated_windows(frame, 3)
    assert out.columns == ["doc_id", "body", "cell", "n_words", "n_removed", "kept_text"]
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "x", 1.5, 3, 0, "a b c"), (2, "y", None, 4, 3, "q")]


def test_a_shared_first_hash_does_not_make_windows_equal():
    high = np.array([5, 5, 5, 9], dtype=np.uint64)
    low = np.array([1, 2, 1, 1], dtype=np.uint32)
    order, heads = window_dedup.by_window(high, low)
    assert order.tolist() == [0, 2, 1, 3] and heads.tolist() == [0, 2, 3]


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    high = np.sort(rng.integers(0, 1 << 64, 500, dtype=np.uint64))
    low, place = (rng.integers(0, 1 << 32, 500, dtype=np.uint32) for _ in range(2))
    doc, variant = rng.integers(-(1 << 62), 1 << 62, 500), rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    back = window_dedup.unpacked_entries(window_dedup.packed_entries(high, low, doc, variant, place))
    assert all(np.array_equal(x, y) for x, y in zip(back, (high, low, doc, variant, place)))
    doc = np.repeat(doc[:50], 10)
    variant = np.repeat(variant[:50], 10)
    got = window_dedup.unpacked_marks(window_dedup.packed_marks(doc, variant, place))
    assert sorted(zip(*(x.tolist() for x in got))) == sorted(zip(doc.tolist(), variant.tolist(), place.tolist()))
