from __future__ import annotations

import random

import numpy as np
import pytest
from brute import groups

from snapstrata.llm.components import components, smallest_members


def plain(links):
    pairs = {(a, b) for a, b in links} | {(b, a) for a, b in links}
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    return groups(nodes, lambda a, b: (a, b) in pairs)


SHAPES = {
    "path": [(k, k + 1) for k in range(60)],
    "star": [(500, k) for k in range(80)],
    "cycle and loops": [(1, 2), (2, 3), (3, 1), (7, 7), (1, 2), (2, 1)],
    "negative": [(-5, 3), (3, 9), (100, 101)],
    "none": [],
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(spark, name):
    frame = spark.createDataFrame(SHAPES[name], "a long, b long")
    assert {r.node: r.component for r in components(frame).collect()} == plain(SHAPES[name])


def test_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == plain(links)
    a, b = np.array(links).T
    nodes, least = smallest_members(a, b)
    want = plain(links)
    assert all(want.get(int(n), int(n)) == int(c) for n, c in zip(nodes, least))
