"""Merkle manifest of a dataset, with inclusion proofs expanded from octopus multiproofs.

A row's leaf is a digest of its fields.  The leaves of a tree (here: of a language), in order of
their id, are hashed in runs of two up to one subroot; the subroots, in order of their tree's name,
make the root in the same way.  A last run of one node is hashed too, so all leaves of a tree are
equally deep; a tree of one leaf is that leaf.

How it runs:

1. Leaves are computed by Spark's own hashes, range-partitioned by (tree, id, leaf) and numbered
   from per-partition counts, so no tree is ever gathered: one tree may hold nearly all rows.
2. ``SPAN`` neighbouring leaves are a leaf partition.  A task hashes its partition to one node, nodes
   are combined by the same step, ``SPAN`` at a time, until each tree has one.  Only nodes above
   leaf partitions are stored.
3. An octopus multiproof serves a whole leaf partition: the least set of coordinates (tree, level,
   place) that the siblings of all its paths need and that it can't derive from its own leaves.
   The coordinates are looked up once, by one join with the stored nodes; the partition derives
   the shared interiors and expands every leaf's proof from the two.

Fields that are null count as ``-``.  Rows with equal tree and id are ordered by their leaf, equal
leaves are interchangeable.  Null ids come first, a null tree is a tree of its own and comes first.
An empty table has no rows and no root.  Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.shared import stored

#: leaves of a leaf partition, and nodes that one step combines: a power of two
SPAN = 1024
#: the tree of the subroots; names of other trees begin with 0 or 1
TOP = ""

NODES = pa.schema(
    [("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("node", pa.string())]
)


def digest(*parts: bytes) -> bytes:
    """sha256 in lowercase hex, of texts joined."""
    return sha256(b"".join(parts)).hexdigest().encode()


def framed(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(framed(f) for f in fields)), 256)


def depth(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    return (n - 1).bit_length()


def levels_above(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the levels above them; a last node without a neighbour is hashed alone."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return out


def missing_coordinates(first: int, last: int, n: int) -> list[tuple[int, int]]:
    """(level, place) of the siblings that neighbouring leaves first to last of n need and can't derive.

    On each level the leaves' ancestors are neighbours too, so at most one sibling lies left
    of them and one right: the least set for all their proofs together.
    """
    out = []
    for level in range(depth(n)):
        if first & 1:
            out.append((level, first - 1))
        if not last & 1 and last + 1 < -(-n >> level):
            out.append((level, last + 1))
        first, last = first >> 1, last >> 1
    return out


class Interiors:
    """The nodes that neighbouring leaves and the fetched coordinates make known."""

    def __init__(self, leaves: list[bytes], first: int, n: int, fetched: dict[tuple[int, int], bytes]):
        self.n = n
        self.known = dict(fetched)
        row, low = leaves, first
        for level in range(depth(n)):
            self.known.update(((level, low + k), node) for k, node in enumerate(row))
            if low & 1:
                row, low = [self.known[level, low - 1], *row], low - 1
            if len(row) & 1 and (level, low + len(row)) in self.known:
                row = [*row, self.known[level, low + len(row)]]
            row, low = [digest(*row[k : k + 2]) for k in range(0, len(row), 2)], low >> 1
        (self.top,) = row

    def siblings(self, place: int) -> list[tuple[bytes | None, bool]]:
        """Level by level the run's other node, if any, and whether it stands left."""
        out = []
        for level in range(depth(self.n)):
            other = place ^ 1
            out.append((self.known.get((level, other)) if other < -(-self.n >> level) else None, bool(place & 1)))
            place >>= 1
        return out


def folded(leaf: bytes, siblings: list[tuple[bytes | None, bool]]) -> bytes:
    for other, left in siblings:
        leaf = digest(leaf) if other is None else digest(other, leaf) if left else digest(leaf, other)
    return leaf


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """A stored copy with _place, the row's number in its tree from 0, and _n, the rows of the tree.

    Range partitions are counted per tree and their counts added up, so rows of one tree spread
    over all tasks.  Rows that tie in everything spread too.
    """
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order, "_tie")]
    laid = spread.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("_tie")
    laid = stored(laid.withColumn("_mark", F.monotonically_increasing_id()), "laid")
    part = F.shiftright("_mark", 33)
    runs = laid.groupBy(tree, part.alias("_part")).agg(F.min("_mark").alias("_low"), F.count(F.lit(1)).alias("_rows"))
    # a row for each tree and range partition, so the window holds at most as many rows as there are partitions
    across = Window.partitionBy(tree)
    before = across.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        tree, "_part", "_low", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"), F.sum("_rows").over(across).alias("_n")
    )
    joined = laid.withColumn("_part", part).join(runs, [tree, "_part"])
    return joined.withColumn("_place", F.col("_base") + F.col("_mark") - F.col("_low")).drop("_mark", "_part", "_low", "_base")


def _combined(nodes: DataFrame, span: int) -> DataFrame:
    """(tree, n, level, place, node) of the nodes above stretches of span nodes; nodes: one level of each tree."""
    up = span.bit_length() - 1

    def combine(key: tuple, group: pa.Table) -> pa.Table:
        tree, n, level, stretch = (x.as_py() for x in key)
        held = [x.encode() for x in group.sort_by("place").column("node").to_pylist()]
        out = []
        for k, above in enumerate(levels_above(held, min(up, depth(n) - level))):
            first = (stretch << up) >> k
            out += [(tree, n, level + k, first + i, node.decode()) for i, node in enumerate(above) if k]
        columns = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, NODES)], schema=NODES)

    stretches = nodes.withColumn("stretch", F.shiftright("place", up)).groupBy("tree", "n", "level", "stretch")
    return stretches.applyInArrow(combine, "tree string, n long, level int, place long, node string")


def upper_nodes(leaves: DataFrame, span: int = SPAN, all_levels: bool = False) -> DataFrame:
    """Stored nodes (tree, n, level, place, node) from the tops of leaf partitions on, or of all levels.

    leaves: (tree, n, place, node).  A step takes all trees up by log2(span) levels, so
    the number of steps is the logarithm, to that base, of the largest tree.
    """
    up = span.bit_length() - 1
    row = leaves.select("tree", "n", F.lit(0).alias("level"), "place", "node")
    most = leaves.agg(F.max("n")).first()[0] or 1
    top = F.expr("shiftright(n - 1, level) = 0")
    out = row if all_levels else row.where(top)
    for at in range(0, depth(most), up):
        above = stored(_combined(row, span), "nodes")
        # what lies inside a leaf partition is derived again where it is needed
        out = out.unionByName(above if at or all_levels else above.where(top | (F.col("level") == up)))
        row = above.where(F.col("level") == at + up)
    return out


def _tops(nodes: DataFrame) -> DataFrame:
    """(tree, node) of each tree's single topmost node."""
    return nodes.where(F.expr("shiftright(n - 1, level) = 0")).select("tree", "node")


def _requests(parts: DataFrame, span: int) -> DataFrame:
    """What leaf partitions fetch: the coordinates they miss, and the roots that are stated.

    parts: (tree, part, n, rank, trees).  Result: (part_tree, part, rank, trees, tree, level, place).
    """
    up = span.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                tree, part, n, rank, trees = (row[c] for c in ("tree", "part", "n", "rank", "trees"))
                wanted = [(tree, *c) for c in missing_coordinates(part << up, min((part + 1) << up, n) - 1, n)]
                wanted += [(TOP, *c) for c in missing_coordinates(rank, rank, trees)]
                wanted += [(tree, depth(n), 0), (TOP, depth(trees), 0)]
                out += [(tree, part, rank, trees, *w) for w in wanted]
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["part_tree", "part", "rank", "trees", "tree", "level", "place"],
            )

    return parts.mapInArrow(run, "part_tree string, part long, rank long, trees long, tree string, level int, place long")


def manifest(
    rows: DataFrame,
    fields: Sequence[str],
    tree: str,
    id: str,
    tampered: dict[str, Column] | None = None,
    when: Column | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Per row: id, leaf, subroot, root, siblings (hex digests, level by level), folded_root, verified.

    tampered gives other expressions for some fields where ``when`` holds; folded_root is
    recomputed from the tampered leaf, or where there is none from the leaf, and the siblings.
    """
    if span < 2 or span & (span - 1):
        raise ValueError("span is a power of two from 2 on")
    own = leaf_digest([F.col(c) for c in fields])
    other = F.lit(None).cast("string")
    if tampered:
        other = leaf_digest([tampered.get(c, F.col(c)) for c in fields])
        other = F.when(F.coalesce(F.lit(True) if when is None else when, F.lit(False)), other)
    # null first: names of other trees get a mark in front that sorts behind it
    name = F.coalesce(F.concat(F.lit("1"), F.col(tree).cast("string")), F.lit("0"))
    leaves = stored(rows.select(name.alias("tree"), F.col(id).alias("id"), own.alias("leaf"), other.alias("other")), "leaves")
    placed = stored(numbered(leaves, "tree", ["id", "leaf"]), "placed")

    nodes = upper_nodes(placed.select("tree", F.col("_n").alias("n"), F.col("_place").alias("place"), F.col("leaf").alias("node")), span)
    ranked = numbered(_tops(nodes).withColumn("all", F.lit(TOP)), "all", ["tree"]).select(
        "tree", "node", F.col("_place").alias("rank"), F.col("_n").alias("trees")
    )
    ranked = stored(ranked, "subroots")
    summits = ranked.select(F.lit(TOP).alias("tree"), F.col("trees").alias("n"), F.col("rank").alias("place"), "node")
    every = nodes.unionByName(upper_nodes(summits, span, all_levels=True))

    up = span.bit_length() - 1
    leaves = placed.withColumnRenamed("_n", "n").withColumn("part", F.shiftright("_place", up))
    parts = leaves.select("tree", "part", "n").distinct().join(ranked.drop("node"), "tree")
    asked = _requests(parts, span)
    fetched = asked.join(every.drop("n"), ["tree", "level", "place"])
    kind = rows.schema[id].dataType.simpleString()
    names = ["id", "leaf", "subroot", "root", "siblings", "folded_root", "verified"]

    def expand(key: tuple, own: pa.Table, held: pa.Table) -> pa.Table:
        own = own.sort_by("_place")
        tree, n, first = key[0].as_py(), own.column("n")[0].as_py(), own.column("_place")[0].as_py()
        rank, trees = (held.column(c)[0].as_py() for c in ("rank", "trees"))
        columns = (held.column(c).to_pylist() for c in ("tree", "level", "place", "node"))
        known = {(t, level, place): node.encode() for t, level, place, node in zip(*columns)}
        subroot, root = known.pop((tree, depth(n), 0)), known.pop((TOP, depth(trees), 0))
        below = Interiors([x.encode() for x in own.column("leaf").to_pylist()], first, n, {c[1:]: x for c, x in known.items() if c[0] == tree})
        beyond = Interiors([below.top], rank, trees, {c[1:]: x for c, x in known.items() if c[0] == TOP})
        shared = beyond.siblings(rank)
        proofs, roots = [], []
        for k, other in enumerate(own.column("other").to_pylist()):
            path = below.siblings(first + k) + shared
            proofs.append([x.decode() for x, _ in path if x is not None])
            roots.append(beyond.top if other is None else folded(other.encode(), path))
        columns = [
            own.column("id"),
            own.column("leaf"),
            pa.array([subroot.decode()] * len(roots)),
            pa.array([root.decode()] * len(roots)),
            pa.array(proofs, pa.list_(pa.string())),
            pa.array([x.decode() for x in roots]),
            pa.array([x == root for x in roots]),
        ]
        return pa.table(columns, names=names)

    groups = leaves.groupBy("tree", "part").cogroup(fetched.groupBy("part_tree", "part"))
    return groups.applyInArrow(
        expand, f"id {kind}, leaf string, subroot string, root string, siblings array<string>, folded_root string, verified boolean"
    )
