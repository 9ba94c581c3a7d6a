from __future__ import annotations

import numpy as np
import pytest
from brute import groups

from snapstrata.llm import embedding_dedup


def brute(rows, threshold):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, dtype=np.float64)
        return v / np.linalg.norm(v)

    units = [None if r[2] is None else unit(r[1]) for r in rows]

    def linked(a, b):
        x, y = units[a], units[b]
        return a != b and x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y) and float(x @ y) >= threshold

    label = groups(range(len(rows)), linked)
    out = []
    for k, (name, _, _) in enumerate(rows):
        members = [rows[j][0] for j in label if label[j] == label[k] and rows[j][0] is not None]
        n = sum(linked(k, j) for j in range(len(rows)))
        component = min(members) if members else None
        out.append((name, n, component, name is not None and name == component))
    return out


def run(spark, rows, threshold=0.93, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_dedup.near_duplicate_vectors(frame, threshold, **options).collect()
    return sorted(map(tuple, found), key=str)


def scattered(n, seed=0):
    """Vectors in groups of all sizes and widths, far apart and close, over three labels."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = rng.normal(size=8)
        spread = rng.choice([0.0, 0.02, 0.15, 0.3])
        for _ in range(int(rng.integers(1, 12))):
            vector = (centre + spread * rng.normal(size=8)).astype(np.float32)
            rows.append((len(rows), [float(x) for x in vector], int(rng.integers(0, 3))))
    return rows[:n]


@pytest.mark.parametrize("options", [{}, {"block": 16}, {"sample_vectors": 40, "block": 64}])
def test_equals_brute_force_whatever_the_cells(spark, options):
    rows = scattered(700)
    assert run(spark, rows, **options) == sorted(brute(rows, 0.93), key=str)


def test_a_low_threshold_links_across_cells(spark):
    rows = scattered(500, seed=3)
    assert run(spark, rows, threshold=0.5, block=32) == sorted(brute(rows, 0.5), key=str)


def test_nulls_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0], None), (11, None, 1),
        (12, [], 1), (13, [0.0, 0.0], 1), (14, [nan, 1.0], 1), (15, [inf, 1.0], 1), (16, [None, 1.0], 1), (17, [1.0, 0.0, 0.0], 1),
        (18, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 5), (19, [-1.0, 0.0], 1),
    ]
    assert run(spark, rows) == sorted(brute(rows, 0.93), key=str)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_crowd_of_copies(spark):
    rows = [(k, [1.0, 2.0, 3.0], 1) for k in range(900)] + [(k, [1.0, 2.0, 3.0 + (k - 900) * 1e-4], 1) for k in range(900, 1300)]
    got = run(spark, rows, block=64)
    assert all(r[1] == 1299 and r[2] == 0 for r in got)
