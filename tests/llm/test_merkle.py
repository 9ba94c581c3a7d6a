from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from snapstrata.llm import merkle_manifest as merkle
from snapstrata.llm.queries import FIELDS, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, **other):
    row = row | other
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, place):
    out = []
    for level in levels[:-1]:
        run = level[place & ~1 : (place & ~1) + 2]
        out.append((place & 1, [x for k, x in enumerate(run) if k != (place & 1)]))
        place >>= 1
    return out


def plainly(rows):
    """The contract's rows, by building both trees whole."""
    order = {}
    for row in rows:
        order.setdefault(row["lang"], []).append(row)
    names = sorted(order, key=lambda x: (x is not None, (x or "").encode()))
    for own in order.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {name: tree_of([leaf_of(r) for r in order[name]]) for name in names}
    top = tree_of([trees[name][-1][0] for name in names])
    out = []
    for rank, name in enumerate(names):
        for place, row in enumerate(order[name]):
            steps = path(trees[name], place) + path(top, rank)
            node = leaf_of(row)
            if row["doc_id"] is not None and crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None:
                node = leaf_of(row, n_chars=row["n_chars"] + 1)
            for right, others in steps:
                node = h(*others, node) if right else h(node, *others)
            proof = h(*(x for _, others in steps for x in others))
            out.append((row["doc_id"], leaf_of(row), trees[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def proved(frame, span):
    out = merkle.manifest(
        frame, FIELDS, "lang", "doc_id", {"n_chars": F.col("n_chars") + 1},
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, span,
    )
    return sorted(
        ((r.id, r.leaf, r.subroot, r.root, h(*r.siblings), r.folded_root, r.verified) for r in out.collect()), key=str
    )


def test_query_equals_brute_force(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r[c] for c in columns) for r in QUERIES["op13_merkle_manifest"](spark, SF).collect()), key=str)
    assert got == plainly(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("span", [2, 4])
def test_trees_of_many_sizes_over_small_leaf_partitions(spark, span):
    rng = random.Random(span)
    rows = []
    for lang, n in [(None, 1), ("", 2), ("é", 3), ("z", 5), ("a", 33), ("aa", 8), ("B", 17)]:
        for _ in range(n):
            rows.append({"doc_id": rng.randrange(-50, 500), "text": rng.choice(["x", "é\n", "", None]), "lang": lang,
                         "source": rng.choice(["s", None]), "n_chars": rng.choice([1, 7, None])})
    frame = spark.createDataFrame([tuple(r[c] for c in SCHEMA.replace(" long", "").replace(" string", "").split(", ")) for r in rows], SCHEMA)
    assert proved(frame.repartition(5), span) == plainly(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(4, "t", "x", "s", 1)] * 4 + [(4, "u", "x", "s", 1), (None, "t", "x", "s", 1)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert proved(frame, 2) == plainly([dict(zip(names, r)) for r in rows])


def test_one_row_empty_table_long_text_and_clashing_names(spark):
    assert proved(spark.createDataFrame([], SCHEMA), 4) == []
    row = (7, "x" * 300_000, "l", "s", 2)
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    frame = spark.createDataFrame([row], SCHEMA).withColumns({"tree": F.lit(1), "leaf": F.lit("q"), "_place": F.lit(0), "node": F.lit(2)})
    got = proved(frame, 4)
    assert got == plainly([dict(zip(names, row))])
    assert got[0][4] == h()


def test_missing_coordinates_are_the_least_set():
    for n in range(1, 40):
        for first in range(n):
            for last in range(first, n):
                known, wanted = {(0, k) for k in range(first, last + 1)}, set()
                for level in range(merkle.depth(n)):
                    width = -(-n // (1 << level))
                    siblings = {(lv, k ^ 1) for lv, k in known if lv == level and k ^ 1 < width}
                    wanted |= siblings - known
                    known |= {(level + 1, k >> 1) for lv, k in known if lv == level}
                assert set(merkle.missing_coordinates(first, last, n)) == wanted


def test_a_proof_of_other_nodes_does_not_fold_to_the_root():
    nodes = [merkle.digest(bytes([k])) for k in range(5)]
    levels = merkle.levels_above(nodes, merkle.depth(5))
    fetched = {c: levels[c[0]][c[1]] for c in merkle.missing_coordinates(2, 3, 5)}
    inner = merkle.Interiors(nodes[2:4], 2, 5, fetched)
    assert inner.top == levels[-1][0]
    assert merkle.folded(nodes[2], inner.siblings(2)) == inner.top
    assert merkle.folded(nodes[2], inner.siblings(3)) != inner.top
    assert merkle.folded(nodes[1], inner.siblings(2)) != inner.top
