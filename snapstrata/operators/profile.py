"""Profiling: shape, candidate keys, group sizes, measures by category."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.operators.dedupe import is_plain_scan
from snapstrata.session import work_area


#: columns whose values are counted in one scan; a counted row has a field for each of them
TOGETHER = 16


def shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, nulls, exact distinct values, smallest and largest value.

    One scan for up to ``TOGETHER`` columns: each column is a grouping set of its own, so values keep their
    types.  Values are counted first, combined on the map side, so a frequent value leaves a task
    once; their counts are folded per column behind that.
    """
    names = list(columns)
    return reduce(DataFrame.unionAll, [_shape(df, names[k : k + TOGETHER]) for k in range(0, len(names), TOGETHER)])


def _shape(df: DataFrame, names: Sequence[str]) -> DataFrame:
    values = df.groupingSets([[F.col(c)] for c in names], *names).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    rows = values.withColumn("_absent", F.coalesce(*[F.when(F.col("_set") == _grouping([c], names), F.col(c).isNull()) for c in names]))
    # only the set of a column has values of it
    ends = [end(c).cast("string").alias(f"{name}{k}") for k, c in enumerate(names) for name, end in (("low", F.min), ("high", F.max))]
    found = rows.groupBy("_set").agg(
        F.sum("_n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_absent"), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count_if(~F.col("_absent")).alias("distinct_values"),
        *ends,
    )
    # columns of an empty table are shown as well
    listed = [(k, c, _grouping([c], names)) for k, c in enumerate(names)]
    every = df.sparkSession.createDataFrame(listed, "place int, column_name string, _set long")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("row_count", "nulls", "distinct_values")]
    low, high = (F.coalesce(*[F.when(F.col("place") == k, F.col(f"{end}{k}")) for k in range(len(names))]) for end in ("low", "high"))
    return F.broadcast(every).join(found, "_set", "left").select(
        "column_name", *counts, low.alias("min_value"), high.alias("max_value")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows repeat an earlier row on the given columns."""
    return candidate_keys(df, {"rows": columns}).select(
        "row_count", "distinct_keys", F.col("rows_dropped").alias("duplicate_rows")
    )


def candidate_keys(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per candidate key: distinct keys, and the rows a dedupe on it would drop."""

    def one(name: str, columns: Sequence[str]) -> DataFrame:
        sizes = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        return sizes.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
        ).select(F.lit(name).alias("candidate"), "*")

    return reduce(DataFrame.unionAll, [one(n, c) for n, c in candidates.items()])


#: the first look at a combination takes one of so many groups of its values
SLICES = 64


def minimal_keys(df: DataFrame, columns: Sequence[str], most: int | None = None) -> DataFrame:
    """(key_columns, n_columns): the least combinations of columns, of up to ``most``, that tell all rows apart.

    The lattice is climbed size by size; combinations that hold a key already found are left out.  Two equal
    rows anywhere disprove a combination, so each is first looked at in one of ``SLICES`` shares of its
    groups, each of which is whole there.  Only those that stand are looked at in all rows, by a hash of their values: where
    no hash repeats, no row does.  NULL is a value like any other here.
    """
    spark = df.sparkSession
    names = list(columns)
    rows = df.select(*names)
    if not is_plain_scan(rows):
        path = work_area(spark, "combinations")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
    keys: list[tuple[str, ...]] = []
    # rows that are equal in all columns: no combination tells them apart
    apart = bool(_apart(rows, [tuple(names)]))
    for size in range(1, (len(names) if most is None else most) + 1) if apart else ():
        open_ = [c for c in combinations(names, size) if not any(set(k) <= set(c) for k in keys)]
        keys += [tuple(names)] if open_ == [tuple(names)] else _apart(rows, open_)
    return spark.createDataFrame([(",".join(k), len(k)) for k in keys], "key_columns string, n_columns int")


def _apart(rows: DataFrame, chosen: Sequence[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The combinations in which no two rows are equal."""
    for slices in (SLICES, 1):
        repeating = _repeating(rows, chosen, slices)
        chosen = [c for c in chosen if c not in repeating]
    return chosen


def _repeating(rows: DataFrame, chosen: Sequence[tuple[str, ...]], slices: int) -> set[tuple[str, ...]]:
    """The combinations in which two rows are equal, from one of ``slices`` shares of their groups (1: all).

    A row per combination is collected.  A repeated hash counts only where values behind it are equal.
    """
    if not chosen:
        return set()
    hashes = [_value_hash(c) for c in chosen]
    share = [rows.select(F.lit(k).alias("_set"), h.alias("_hash")).where(F.pmod("_hash", F.lit(slices)) == 0) for k, h in enumerate(hashes)]
    again = reduce(DataFrame.unionAll, share).groupBy("_set", "_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    seen = {r["_set"]: r["_hash"] for r in again.groupBy("_set").agg(F.min("_hash").alias("_hash")).collect()}
    if not seen:
        return set()

    def equal(k: int, source: DataFrame) -> DataFrame:
        return source.groupBy(*chosen[k]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").agg(F.lit(k).alias("_set"), F.count(F.lit(1)).alias("_groups"))

    shown = reduce(DataFrame.unionAll, [equal(k, rows.where(hashes[k] == F.lit(h))) for k, h in seen.items()])
    # different values that share the hash looked at: all values decide
    return {chosen[r["_set"]] for r in shown.collect() if r["_groups"] or equal(r["_set"], rows).first()["_groups"]}


def _value_hash(names: Sequence[str]):
    """A hash of the values that also tells which of them are NULL."""
    return F.xxhash64(*names, reduce(lambda a, b: a + b, [F.when(F.isnull(n), 1 << k).otherwise(0) for k, n in enumerate(names)]))


def _grouping(chosen: Sequence[str], names: Sequence[str]) -> int:
    """What ``grouping_id`` gives for a grouping set: a bit for each column that is not in it."""
    return sum(1 << (len(names) - 1 - k) for k, n in enumerate(names) if n not in chosen)


def differing_attributes(
    df: DataFrame, key: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Per attribute: in how many repeated keys its value differs between the rows.

    Whether values differ shows in min <> max (plus NULL beside non-NULL), which
    combines on the map side; no distinct sets are built.
    """
    spread = []
    for i, a in enumerate(attributes):
        spread += [F.min(a).alias(f"lo{i}"), F.max(a).alias(f"hi{i}"), F.count(a).alias(f"n{i}")]
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *spread).where(F.col("n") > 1)

    def varies(i: int):
        mixed_null = (F.col(f"n{i}") > 0) & (F.col(f"n{i}") < F.col("n"))
        return (F.col(f"lo{i}") != F.col(f"hi{i}")) | mixed_null

    totals = groups.agg(
        F.count(F.lit(1)).alias("groups"),
        *[F.count_if(varies(i)).alias(f"d{i}") for i in range(len(attributes))],
    )
    rows = [
        F.struct(
            F.lit(a).alias("attribute"),
            F.col("groups").alias("repeated_keys"),
            F.col(f"d{i}").alias("keys_that_differ"),
        )
        for i, a in enumerate(attributes)
    ]
    return totals.select(F.inline(F.array(*rows)))


def group_size_histogram(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many groups there are of each size."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("group_count"))


def measure_by_category(
    df: DataFrame, category: Sequence[str], measure: str
) -> DataFrame:
    """Volume, exact total, smallest, largest and mean value per category."""
    amount = F.col(measure).cast("decimal(18,2)")
    return df.groupBy(*category).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(measure).alias("min_value"),
        F.max(measure).alias("max_value"),
        F.round(
            (F.sum(amount) * 100).cast("double") / (F.count(amount) * F.lit(100.0)), 4
        ).alias("mean_value"),
    )
