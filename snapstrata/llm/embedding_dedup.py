"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors of a label are folded to one class first.  Spherical k-means, fitted on a
bounded sample of the classes, assigns each class to the cell of its nearest centroid.
Two vectors within an angle t of each other may still fall into different cells c
and d; then the one in d is no farther than t from the plane between the
centroids: u.(d - c) / |d - c| <= sin t.  Every vector for which that holds is also shown
to cell c (the lower of the two), so comparing within cells finds every
link, whatever the quality of the centroids; they decide the cost alone.

Cells are cut into blocks, and pairs of blocks are units of work of bounded size, multiplied as
matrices in double precision.  A unit emits for each class the number of vectors that it
links with there and the smallest one it reaches, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
nor do vectors without a label; vectors of different lengths are not compared.  Repeated rows are
vectors of their own that link.  A component's id is its smallest non-null vec_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.components import components, smallest_members
from snapstrata.llm.shared import Shipped, stored

#: bound of the sample that the centroids are fitted on, and rounds of fitting
SAMPLE_VECTORS = 20_000
ROUNDS = 8
#: vectors of a block
BLOCK = 2048
#: slack for rounding where exactness depends on a comparison
SLACK = 1e-9


def unit_rows(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    # the largest component first, so that squares neither overflow nor vanish
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids; a centroid without members starts again at one of the vectors that fit worst."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), cells, replace=False)].copy()
    for _ in range(rounds):
        likeness = vectors @ centroids.T
        nearest = likeness.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        size = np.sqrt((sums * sums).sum(axis=1))
        bare = np.flatnonzero(size < 1e-12)
        if len(bare):
            worst = np.argsort(likeness.max(axis=1))[: len(bare)]
            sums[bare], size[bare] = vectors[worst], 1.0
        centroids = sums / size[:, None]
    return centroids


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def shown_in(units: np.ndarray, centroids: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(cell, rows, whether the cell is their own) for each cell."""
    likeness = units @ centroids.T
    home = likeness.argmax(axis=1)
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + SLACK
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T))
    own = likeness[np.arange(len(units)), home]
    for cell in range(len(centroids)):
        near = (home > cell) & (own - likeness[:, cell] <= reach * apart[home, cell] + SLACK)
        rows = np.flatnonzero(near | (home == cell))
        if len(rows):
            yield cell, rows, home[rows] == cell


def compare_blocks(
    ids: np.ndarray, n: np.ndarray, home: np.ndarray, units: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the rows of two blocks (or within one): class, smallest class reached, vectors linked with."""
    same = first is second
    links = np.zeros(len(ids), dtype=np.int64)
    left, right = [], []
    for at in range(0, len(first), 512):
        rows = first[at : at + 512]
        hit = units[rows] @ units[second].T >= threshold
        hit &= home[rows][:, None] | home[second][None, :]
        if same:
            hit &= np.arange(at, at + len(rows))[:, None] < np.arange(len(second))[None, :]
        p, q = np.nonzero(hit)
        p, q = rows[p], second[q]
        np.add.at(links, p, n[q])
        np.add.at(links, q, n[p])
        # a forest of the links found so far is enough
        a, b = smallest_members(ids[p], ids[q])
        left.append(a)
        right.append(b)
    a, b = smallest_members(np.concatenate(left), np.concatenate(right))
    linked = np.flatnonzero(links)
    order = np.argsort(ids[linked])
    return a, b, links[linked][order]


def link_classes(classes: DataFrame, threshold: float, sample_vectors: int = SAMPLE_VECTORS, block: int = BLOCK) -> DataFrame:
    """(a, b, links): for each class that links, per unit of work, the smallest class reached and the vectors linked.

    classes is a stored table: class_id, label, vector, n.
    """
    spark = classes.sparkSession
    sizes = classes.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").first()
    length, count = (sizes["length"], sizes["n"]) if sizes else (0, 0)
    cells = max(1, math.ceil(math.sqrt(count) / 16))
    scale = 1 << 30
    share = min(scale, math.ceil(scale * sample_vectors / max(1, count)))
    if cells > 1:
        picked = classes.where((F.size("vector") == length) & (F.pmod(F.xxhash64("vector"), F.lit(scale)) < share))
        rows = picked.select("vector").limit(2 * sample_vectors).collect()
        sample = unit_rows(np.array(sorted(r.vector for r in rows), dtype=np.float64))
        cells = min(cells, len(sample))
        centroids = spherical_kmeans(sample, cells)
    else:
        centroids = np.zeros((1, length))
    model = Shipped(spark, centroids)
    schema = T.StructType(
        [
            classes.schema["label"],
            T.StructField("length", T.LongType()),
            T.StructField("cell", T.LongType()),
            T.StructField("home", T.BooleanType()),
            T.StructField("class_id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("vector", T.BinaryType()),
        ]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = model.value
        for whole in batches:
            sizes = np.diff(whole.column("vector").offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                batch = whole.filter(pa.array(sizes == size))
                units = unit_rows(_matrix(batch.column("vector")))
                # vectors of another length than the model's share one cell
                shown = shown_in(units, centroids, threshold) if size == centroids.shape[1] and len(centroids) > 1 else [(0, np.arange(len(units)), np.ones(len(units), dtype=bool))]
                packed = pa.array([row.tobytes() for row in units], pa.binary())
                for cell, rows, home in shown:
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("label").take(take),
                            pa.array(np.full(len(rows), size), pa.int64()),
                            pa.array(np.full(len(rows), cell), pa.int64()),
                            pa.array(home),
                            batch.column("class_id").take(take),
                            batch.column("n").take(take),
                            packed.take(take),
                        ],
                        names=schema.names,
                    )

    assigned = stored(classes.select("label", "vector", "class_id", "n").mapInArrow(assign, schema), "cells")
    cell = ["label", "length", "cell"]
    counts = assigned.groupBy(cell).agg(F.count("*").alias("rows")).where("rows > 1")
    dealt = (
        assigned.join(counts, cell)
        .withColumn("blocks", F.ceil(F.col("rows") / F.lit(block)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*cell, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "home", "class_id", "n", "vector")
    )

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        ids, n = rows.column("class_id").to_numpy(), rows.column("n").to_numpy()
        units = np.frombuffer(b"".join(rows.column("vector").to_pylist()), dtype=np.float64).reshape(len(ids), -1)
        own = rows.column("own").to_numpy()
        home = rows.column("home").to_numpy()
        first = np.flatnonzero(own == key[3].as_py())
        second = first if key[3] == key[4] else np.flatnonzero(own == key[4].as_py())
        if not len(first) or not len(second):
            a = b = links = np.zeros(0, dtype=np.int64)
        else:
            a, b, links = compare_blocks(ids, n, home, units, first, second, threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return dealt.groupBy(*cell, "i", "j").applyInArrow(compare, "a long, b long, links long")


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    sample_vectors: int = SAMPLE_VECTORS, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold is a cosine above 0")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = stored(
        good.groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    found = stored(link_classes(classes, threshold, sample_vectors, block), "links")
    groups = components(found)
    linked = found.groupBy(F.col("a").alias("class_id")).agg(F.sum("links").alias("links"))
    named = stored(
        classes.join(linked, "class_id", "left").join(groups, F.col("class_id") == F.col("node"), "left")
        .select("label", "vector", "n", "least_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "class_id").alias("component")),
        "classes",
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = named.join(least, "component").select("label", "vector", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    joined = good.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id", kept)
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long"), "vec_id", F.col("vec_id").isNotNull())
    return joined.unionAll(alone)
