"""SimHash near-duplicates: byte-position inverted index with count filtering.

A text's fingerprint has bit k set if bit k is set in over half of the XXH64
values of its word shingles.  Two fingerprints that differ in at most d bits
differ in at most d of their 8 bytes, so they share at least 8 - d bytes at the
same positions.  The index lists fingerprints under the bytes they hold at given
positions; pairs that meet in a list are tallied by shared positional bytes, kept
from 8 - d on, and verified by their bit distance.

Lists under a single byte would hold 1/256 of all fingerprints.  Of 8 - d shared
positions at least half, rounded up, fall into one half of the eight, so lists
are kept per combination of that many positions out of a half: for d = 3 there
are eight kinds of lists, under 24 bits each, and no qualifying pair misses all.

Long lists are cut into blocks and block pairs are dealt out as units of work of
bounded size.  What leaves a unit is a link from each fingerprint to the
smallest one that it reaches there, not the pairs.

Null, empty and blank texts have fingerprint zero and link like any other.
Equal texts and repeated rows share a fingerprint.  Rows without a doc_id take
part; a component's id is its smallest non-null doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from snapstrata.llm.components import components, smallest_members
from snapstrata.llm.shared import stored
from snapstrata.llm.texts import blank_separated, pieces, split_words

SEED = 42
#: shingles whose bits are held at once
SHINGLE_ROWS = 1 << 16
#: fingerprints of a list that are compared with each other as one unit of work
BLOCK = 256


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """The 64-bit fingerprint of each text, unsigned."""
    words, ends = split_words(texts, blank_separated())
    out = np.zeros(len(texts), dtype=np.uint64)
    if not len(words):
        return out
    spaced = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    _, places, data = spaced.buffers()
    starts = np.frombuffer(places, dtype=np.int64)[: len(words) + 1]
    raw = data.to_pybytes()
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for doc in range(len(texts)):
        first, last = int(ends[doc]), int(ends[doc + 1])
        if first == last:
            continue
        n = max(1, last - first - shingle + 1)
        width = min(shingle, last - first)
        counts = np.zeros(64, dtype=np.int64)
        for at in range(first, first + n, SHINGLE_ROWS):
            upto = min(at + SHINGLE_ROWS, first + n)
            begins = starts[at:upto].tolist()
            closes = (starts[at + width : upto + width] - 1).tolist()
            hashes = np.array([xxh64_intdigest(raw[x:y], SEED) for x, y in zip(begins, closes)], dtype="<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint32)
        out[doc] = weights[2 * counts > n].sum(dtype=np.uint64)
    return out


def with_fingerprint(
    docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint", keep: list[str] | None = None
) -> DataFrame:
    """The columns in keep (all by default) and a long that holds the 64 bits.  A column of that name is replaced."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    read = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*(read.schema[c] for c in kept), T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            value = fingerprints_of(piece.column(text), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(value)], names=[*kept, name])

    return read.mapInArrow(run, schema)


def _list_keys(value: Column, max_distance: int) -> Column:
    width = -(-(8 - max_distance) // 2)
    keys = []
    kinds = [*combinations(range(4), width), *combinations(range(4, 8), width)]
    for kind, positions in enumerate(kinds):
        key = F.lit(kind).cast("long")
        for position in positions:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255)))
        keys.append(key)
    return F.array(*keys)


def linked_in_units(unit: np.ndarray, value: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal units: pairs at each offset are tallied, filtered and verified as arrays."""
    left, right = [], []
    at = np.arange(len(unit))
    step = 0
    while len(at):
        step += 1
        at = at[at + step < len(unit)]
        at = at[unit[at] == unit[at + step]]
        if not len(at):
            break
        differ = value[at] ^ value[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        hit = at[(shared >= 8 - max_distance) & (np.bitwise_count(differ) <= max_distance)]
        left.append(hit)
        right.append(hit + step)
    a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
    return a, b


def fingerprint_links(distinct: DataFrame, value: str = "fingerprint", max_distance: int = 3, block: int = BLOCK) -> DataFrame:
    """(a, b) of links among distinct fingerprints, enough of them to join each component."""
    if not 0 <= max_distance <= 7:
        raise ValueError("max_distance is 0 to 7: beyond that no byte has to be shared")
    lists = distinct.select(F.explode(_list_keys(F.col(value), max_distance)).alias("key"), F.col(value).alias("value"))
    sizes = lists.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    dealt = (
        lists.join(sizes, "key")
        .select("key", "value", blocks.alias("blocks"))
        .withColumn("own", F.pmod(F.xxhash64("value"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "value")
    )
    spark = distinct.sparkSession
    units = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").sortWithinPartitions("unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def links(unit, held):
            a, b = linked_in_units(unit, held, max_distance)
            low, high = smallest_members(held[a].view(np.int64), held[b].view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

        for batch in batches:
            unit = np.concatenate([unit, batch.column(0).to_numpy()])
            held = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(unit, unit[-1], side="left")) if len(unit) else 0
            if whole:
                yield links(unit[:whole], held[:whole])
                unit, held = unit[whole:], held[whole:]
        yield links(unit, held)

    return units.mapInArrow(run, "a long, b long")


def fingerprint_components(
    prints: DataFrame, doc_id: str = "doc_id", value: str = "fingerprint", max_distance: int = 3
) -> DataFrame:
    """One row per distinct fingerprint of a stored table: (fingerprint, component, component_id).

    component is the smallest fingerprint of the component, component_id its smallest doc_id, which
    may be null or shared with another component.
    """
    distinct = stored(prints.groupBy(value).agg(F.min(doc_id).alias("least_id")), "fingerprints")
    groups = components(fingerprint_links(distinct, value, max_distance))
    named = distinct.join(groups, distinct[value] == groups["node"], "left").select(
        distinct[value], "least_id", F.coalesce("component", distinct[value]).alias("component")
    )
    named = stored(named, "fingerprints")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return named.join(least, "component").select(value, "component", "component_id")


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """(doc_id, fingerprint as long, component_id), a row for each row of docs."""
    prints = stored(with_fingerprint(docs, text, shingle, keep=[doc_id]), "fingerprints")
    found = fingerprint_components(prints, doc_id, "fingerprint", max_distance)
    return prints.join(found, "fingerprint").select(doc_id, "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """docs with one row of each group: the smallest doc_id, then the smallest hash of the whole row.

    Rows that are equal in every column count as one.  docs should be a stored table, as it is read twice.
    """
    row = F.xxhash64(*docs.columns)
    marked = docs.withColumn("row_hash#", row)
    prints = stored(with_fingerprint(marked, text, shingle, "fingerprint#", [doc_id, "row_hash#"]), "fingerprints")
    found = fingerprint_components(prints, doc_id, "fingerprint#", max_distance)
    # groups without ids or with a repeated one share a component_id, so they are told apart by their fingerprint
    best = prints.groupBy("fingerprint#").agg(
        F.min(F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col("row_hash#").alias("h"))).alias("row")
    )
    groups = best.join(found, "fingerprint#").groupBy("component").agg(F.min("row").alias("row"))
    kept = stored(groups.select(F.col("row.id").alias("kept_id"), F.col("row.h").alias("kept_hash")).distinct(), "kept")
    once = marked.join(kept, marked["row_hash#"].eqNullSafe(kept.kept_hash) & marked[doc_id].eqNullSafe(kept.kept_id), "left_semi")
    repeated = stored(
        prints.groupBy(doc_id, "row_hash#").agg(F.count("*").alias("copies")).where("copies > 1")
        .select(F.col(doc_id).alias("repeated_id"), F.col("row_hash#").alias("repeated_hash")),
        "repeated",
    )
    if not repeated.isEmpty():
        same = once["row_hash#"].eqNullSafe(repeated.repeated_hash) & once[doc_id].eqNullSafe(repeated.repeated_id)
        folded = once.join(repeated, same, "left_semi").dropDuplicates([doc_id, "row_hash#"])
        once = once.join(repeated, same, "left_anti").unionAll(folded)
    return once.select(*docs.columns)
