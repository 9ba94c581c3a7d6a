"""Connected components of a link table, by alternating star contractions.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond") move every link towards the smallest member until the
table is a set of stars.  Each round is two aggregations with map-side combine
and two joins, so a node with very many links is never gathered in one task,
and its table is written to the shared folder, so lost executors cost a round
at most.  Only one line of counts per round reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.shared import stored


def smallest_members(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inside a task: the nodes of the links, and the smallest node linked with each."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is its smallest reachable node.

    Links between a node and itself, repeated links and either direction are fine.
    """
    links = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    links = stored(links, "links")
    before = _state(links)
    while before[0]:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        links = stored(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    tips = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tips.unionAll(roots)
