from __future__ import annotations

import random

import pytest
from brute import contamination
from pyspark.sql import functions as F

from snapstrata.llm import decontamination
from snapstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def judged(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string, matches int")
    b = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    rows = decontamination.find_contamination(d, b, **options).collect()
    return {r.doc_id: (r.n_words, r.n_hit, len(r.item_ids), r.item_ids, r.contaminated, r.matches) for r in rows}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op1_benchmark_decontamination"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert any(r.contaminated for r in got.values())
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == contamination(d.text, items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_random_texts_short_items_and_blocks(spark, block_bytes):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "é", "7"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.randint(1, 9)), 0) for k in range(12)] + [(20, None, 0), (21, " ,. ", 0), (None, "a b c", 0)]
    items += [(30, items[0][1], 0), (3, "c c b b a a", 0)]
    docs = [(k, say(rng.randint(0, 60)).upper() + ".\n", "x", 1) for k in range(40)] + [(100, None, "x", 1), (101, "", "x", 1)]
    got = judged(spark, docs, items, window=4, block_bytes=block_bytes)
    for doc_id, text, *_ in docs:
        n_words, n_hit, n_items, _, dirty = contamination(text, [i[:2] for i in items], window=4)
        assert got[doc_id][:3] == (n_words, n_hit, n_items)
        assert got[doc_id][4] == dirty


def test_longest_matches_and_their_places(spark):
    item = " ".join(f"w{k}" for k in range(40))
    text = "Before, W3 " + " ".join(f"w{k}" for k in range(5, 30)) + " after."
    got = judged(spark, [(1, text, "x", 0), (2, "w1 w2", "x", 0)], [(9, item, 0)])
    (match,) = got[1][5]
    assert (match.item_id, match.doc_word, match.item_word, match.n_words) == ("9", 2, 5, 25)
    assert got[2][1:3] == (0, 0) and not got[2][4]


def test_windows_do_not_cross_texts(spark):
    got = judged(spark, [(1, "a b", "x", 0), (2, "c d", "x", 0)], [(1, "a b c d", 0)], window=4)
    assert got[1][1] == got[2][1] == 0


def test_many_distinct_words_fill_the_keys(spark):
    words = [f"x{k}" for k in range(3000)]
    items = [(k, " ".join(words[k * 30 : k * 30 + 30]), 0) for k in range(100)]
    docs = [(k, " ".join(words[k * 30 + 3 : k * 30 + 19]), "x", 0) for k in range(100)]
    got = judged(spark, docs, items)
    assert all(got[k][1:4] == (16, 1, [str(k)]) for k in range(100))


def test_drop_keeps_clean_rows_and_all_columns(spark):
    item = " ".join(f"w{k}" for k in range(13))
    docs = spark.createDataFrame([(1, item, "keep"), (1, item, "keep"), (2, "clean", "keep"), (3, None, None)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    (row,) = decontamination.find_contamination(docs, none).collect()
    assert (row.n_words, row.n_hit, row.item_ids, row.contaminated) == (3, 0, [], False)
    assert decontamination.find_contamination(docs.limit(0), none).count() == 0
    assert decontamination.drop_contaminated(docs, none).count() == 1


def test_very_long_text(spark):
    text = "a " * 400_000 + "needle in the hay " + "b " * 10
    docs = spark.createDataFrame([(1,)], "doc_id long").withColumn("text", F.lit(text))
    bench = spark.createDataFrame([(1, "needle in the hay")], "item_id long, text string")
    (row,) = decontamination.find_contamination(docs, bench).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (400_014, 4, False)
