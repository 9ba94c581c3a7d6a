from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from brute import fingerprint, groups

from snapstrata.llm import simhash_dedup
from snapstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(a: int, b: int, most: int = 3) -> bool:
    return (a ^ b).bit_count() <= most


def test_fingerprints_equal_brute_force():
    texts = ["", None, " \n\t", "One", "one TWO", "a b c d e a b c", "É a\x0bb c", "x " * 300, "Ab  cd\r\nEf gh"]
    got = simhash_dedup.fingerprints_of(pa.array(texts), 3)
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op5_simhash_near_dedup"](spark, SF).collect()}
    want = {d.doc_id: fingerprint(d.text) for d in docs}
    assert {k: int(r.fingerprint, 16) for k, r in got.items()} == want
    assert all(len(r.fingerprint) == 16 for r in got.values())
    component = groups(list(want), lambda a, b: near(want[a], want[b]))
    assert {k: r.component_id for k, r in got.items()} == component
    assert len(set(component.values())) < len(component)


def test_links_of_crowded_fingerprints_in_small_blocks(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    values = set()
    for centre in centres:
        for _ in range(60):
            value = centre
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    signed = sorted(int(np.uint64(v).view(np.int64)) for v in values)
    frame = spark.createDataFrame([(v, v) for v in signed], "fingerprint long, doc_id long")
    got = {r.fingerprint: r.component_id for r in simhash_dedup.fingerprint_components(frame).collect()}
    bits = {v: int(np.int64(v).view(np.uint64)) for v in signed}
    assert got == groups(signed, lambda a, b: near(bits[a], bits[b]))
    links = simhash_dedup.fingerprint_links(frame.select("fingerprint"), max_distance=5, block=16).collect()
    linked = {(r.a, r.b) for r in links}
    every = groups(signed, lambda a, b: near(bits[a], bits[b], 5))
    assert groups(signed, lambda a, b: (a, b) in linked or (b, a) in linked) == every


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(5, None, "a"), (3, "", "b"), (None, "  ", "c"), (9, "alpha beta gamma", "d"), (9, "alpha beta gamma", "d"), (2, "other words here now", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash_dedup.simhash_groups(docs).collect())
    assert got == [(-1, 3), (2, 2), (3, 3), (5, 3), (9, 9), (9, 9)]
    kept = simhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "other words here now", "e"), (3, "", "b"), (9, "alpha beta gamma", "d")]


def test_one_row_stays_where_an_id_repeats_with_near_texts(spark):
    text = " ".join(f"w{k}" for k in range(400))
    docs = spark.createDataFrame([(1, text + " end"), (1, text + " tail"), (2, text)], "doc_id long, text string")
    component = {r.component_id for r in simhash_dedup.simhash_groups(docs).collect()}
    kept = simhash_dedup.drop_near_duplicates(docs).collect()
    assert len(kept) == len(component)


def test_unlinked_texts_without_or_with_a_repeated_id_all_stay(spark):
    texts = ["alpha beta gamma delta", "other words here now", "one two three four", "red green blue black"]
    prints = [fingerprint(t) for t in texts]
    assert not any(near(a, b) for k, a in enumerate(prints) for b in prints[:k])
    rows = [*((None, t) for t in texts[:2]), *((7, t) for t in texts[2:]), (None, texts[0]), (8, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash_dedup.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == sorted([(-1, t) for t in texts[:2]] + [(7, t) for t in texts[2:]])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.simhash_groups(docs).count() == 0
    assert simhash_dedup.drop_near_duplicates(docs).count() == 0
