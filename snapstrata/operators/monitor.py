"""Checks over the audit tables and marts.

Each takes rows that are already aggregated (one per snapshot, reason, cabin or
layer run) and returns ``check_name, subject, as_of_date, value, threshold,
status``.  Windows here run over such rows only, within one subject, so they
grow by one row per day.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OK, ALERT = "ok", "alert"


def _verdict(
    df: DataFrame,
    check: str,
    subject: Column,
    day: Column,
    value: Column,
    threshold: float,
    breach: Column,
) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        subject.cast("string").alias("subject"),
        day.cast("date").alias("as_of_date"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(breach, ALERT).otherwise(OK).alias("status"),
    )


def alerts(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("status") == ALERT)


def reconciliation(run_log: DataFrame) -> DataFrame:
    """Runs whose layers do not add up."""
    missing = F.col("bronze_row_count") - F.coalesce(
        F.col("silver_valid_count") + F.col("silver_rejected_count"), F.col("bronze_row_count")
    )
    broken = ~F.coalesce("reconciled", F.lit(False))
    return _verdict(
        run_log, "reconciliation", F.col("layer"), F.col("as_of_date"), missing, 0, broken
    )


def schema_drift(report: DataFrame, day: date) -> DataFrame:
    """Any difference other than column order is an alert."""
    structural = F.col("drift") != "reordered_columns"
    return _verdict(
        report, "schema_drift", F.col("column_name"), F.lit(day), F.lit(1.0), 0, structural
    )


def unparsable_values(report: DataFrame, day: date) -> DataFrame:
    """Columns holding text that does not parse as the contract's type (``value_drift``)."""
    bad = F.col("unparsable_rows")
    return _verdict(report, "schema_drift", F.col("column_name"), F.lit(day), bad, 0, bad > 0)


def missing_snapshots(snapshots: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Expected days without a snapshot.

    The calendar is joined to the distinct days present, so the table's rows are
    folded to days before anything is compared.
    """
    spark = snapshots.sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("expected")
    )
    present = snapshots.select(F.col(column).cast("date").alias("expected")).distinct()
    gaps = days.join(present, "expected", "left_anti")
    return _verdict(
        gaps, "missing_snapshot", F.lit("snapshot"), F.col("expected"), F.lit(0.0), 1, F.lit(True)
    )


def test_failures(counts: DataFrame, day: date) -> DataFrame:
    failures = F.col("failures")
    return _verdict(
        counts, "table_test", F.col("test_name"), F.lit(day), failures, 0, failures > 0
    )


def rejected_share(summary: DataFrame, limit: float = 2.0) -> DataFrame:
    """Snapshots that turn away more than ``limit`` percent of their rows."""
    per_day = summary.groupBy("as_of_date").agg(F.max("rejected_pct").alias("pct"))
    pct = F.col("pct")
    return _verdict(
        per_day, "rejected_pct", F.lit("snapshot"), F.col("as_of_date"), pct, limit, pct > limit
    )


def daily_volume(df: DataFrame, timestamp: str, subject: str) -> DataFrame:
    """Rows per subject and day."""
    return df.groupBy(
        F.col(subject).alias("subject"), F.col(timestamp).cast("date").alias("as_of_date")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def volume_against_median(
    volumes: DataFrame, days: int = 7, tolerance: float = 0.20
) -> DataFrame:
    """Row count against the median of the ``days`` calendar days before."""
    trailing = (
        Window.partitionBy("subject")
        .orderBy(F.unix_date("as_of_date"))
        .rangeBetween(-days, -1)
    )
    with_median = volumes.withColumn("median", F.percentile("row_count", F.lit(0.5)).over(trailing))
    change = F.col("row_count") / F.col("median") - 1
    return _verdict(
        with_median,
        "volume_vs_median",
        F.col("subject"),
        F.col("as_of_date"),
        F.round(change, 6),
        tolerance,
        F.abs(change) > tolerance,
    )


def first_seen(reasons: DataFrame) -> DataFrame:
    """Each reason once, on the first snapshot it ever occurred in.

    Alerts unless that is the very first snapshot on record.
    """
    firsts = reasons.groupBy("reason").agg(F.min("as_of_date").alias("first_day"))
    # one row per reason by now; the earliest of their first days opens the record
    joined = firsts.withColumn("start", F.min("first_day").over(Window.partitionBy()))
    return _verdict(
        joined,
        "first_seen_reason",
        F.col("reason"),
        F.col("first_day"),
        F.lit(1.0),
        0,
        F.col("first_day") > F.col("start"),
    )


def against_previous(
    df: DataFrame, check: str, subject: str, measure: str, tolerance: float
) -> DataFrame:
    """Relative change of a measure against the snapshot before, per subject."""
    order = Window.partitionBy("subject").orderBy("as_of_date")
    rows = df.select(
        F.col(subject).cast("string").alias("subject"),
        "as_of_date",
        F.col(measure).cast("double").alias("now"),
    ).withColumn("before", F.lag("now").over(order))
    change = F.when(F.col("before") != 0, F.col("now") / F.col("before") - 1)
    return _verdict(
        rows,
        check,
        F.col("subject"),
        F.col("as_of_date"),
        F.round(change, 6),
        tolerance,
        F.abs(change) > tolerance,
    )


def fare_by_cabin(cube: DataFrame) -> DataFrame:
    """Mean fare per cabin and snapshot, the input of the fare-change check."""
    return cube.groupBy("cabin_class", "as_of_date").agg(
        (F.sum("price_sum").cast("double") / F.sum("priced")).alias("mean_fare")
    )


def runtime_against_average(run_log: DataFrame, runs: int = 7, factor: float = 2.0) -> DataFrame:
    """Layer runtime against the average of its ``runs`` runs before."""
    before = (
        Window.partitionBy("layer").orderBy("as_of_date", "logged_at").rowsBetween(-runs, -1)
    )
    rows = run_log.withColumn("usual", F.avg("runtime_seconds").over(before))
    ratio = F.when(F.col("usual") > 0, F.col("runtime_seconds") / F.col("usual"))
    return _verdict(
        rows,
        "runtime_vs_average",
        F.col("layer"),
        F.col("as_of_date"),
        F.round(ratio, 6),
        factor,
        ratio > factor,
    )


def key_skew(df: DataFrame, keys: list[str], limit: float = 2.0) -> DataFrame:
    """Largest group over the average group, per key column."""
    def one(key: str) -> DataFrame:
        return (
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.max("n").alias("largest"),
                F.sum("n").alias("total"),
                F.count(F.lit(1)).alias("groups"),
            )
            .withColumn("key", F.lit(key))
        )

    folded = reduce(DataFrame.unionAll, [one(k) for k in keys])
    ratio = F.col("largest") * F.col("groups") / F.col("total")
    return _verdict(
        folded,
        "key_skew",
        F.col("key"),
        F.lit(None),
        F.round(ratio, 6),
        limit,
        ratio > limit,
    )


#: cells of each row of the sketch
SKETCH = 1 << 12


def _cell(key: str, row: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), F.col(key)), F.lit(SKETCH)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], share: int, of: int, depth: int = 2) -> DataFrame:
    """(key_column, key_value, row_count) of the values that hold at least ``share / of`` of the rows.

    A count-min sketch of fixed size comes first: per key column ``depth`` rows of cells, each the
    number of rows whose value falls into it.  A hot value makes all its cells hot, so the
    candidates, rows in hot cells only, hold every hot value; they alone are grouped and counted exactly.  Both
    passes combine on the map side, and the first leaves a bounded number of rows per task.
    At most ``of / share`` cells of a row can be hot: that bounds what reaches the driver.
    """
    cells = [F.struct(F.lit(k).alias("k"), F.lit(r).alias("r"), _cell(c, r).alias("cell")) for k, c in enumerate(keys) for r in range(depth)]
    sketch = df.select(F.explode(F.array(*cells)).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum(F.when((F.col("s.k") == 0) & (F.col("s.r") == 0), F.col("n"))).over(Window.partitionBy())
    hot = sketch.withColumn("total", total).where(F.col("n") * of >= F.col("total") * share)
    held = [(r["s"]["k"], r["s"]["r"], r["s"]["cell"], r["total"]) for r in hot.collect()]
    least = (held[0][3] * share if held else 0, of)

    def among(k: int, r: int) -> Column:
        return _cell(keys[k], r).isin(*[cell for a, b, cell, _ in held if (a, b) == (k, r)])

    found = []
    for k, key in enumerate(keys):
        candidate = reduce(and_, [among(k, r) for r in range(depth)])
        counted = df.where(candidate).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
        shown = counted.where(F.col("row_count") * least[1] >= least[0])
        found.append(shown.select(F.lit(key).alias("key_column"), F.col(key).cast("string").alias("key_value"), "row_count"))
    return reduce(DataFrame.unionAll, found)


def repeated_content(deliveries: DataFrame) -> DataFrame:
    """Contents delivered more than once."""
    counted = deliveries.groupBy("file_hash").agg(
        F.count(F.lit(1)).alias("n"), F.max("as_of_date").alias("last_day")
    )
    return _verdict(
        counted.where(F.col("n") > 1),
        "repeated_delivery",
        F.col("file_hash"),
        F.col("last_day"),
        F.col("n"),
        1,
        F.lit(True),
    )


def cardinality(
    df: DataFrame, expected: dict[str, int], snapshot: str = "as_of_date"
) -> DataFrame:
    """Distinct values per snapshot against the number the contract expects."""
    def one(column: str, want: int) -> DataFrame:
        counted = df.groupBy(snapshot).agg(F.count_distinct(column).alias("n"))
        n = F.col("n")
        return _verdict(
            counted, "cardinality", F.lit(column), F.col(snapshot), n, want, n != want
        )

    return reduce(DataFrame.unionAll, [one(c, n) for c, n in expected.items()])


def lost_members(df: DataFrame, members: list[str], snapshot: str = "as_of_date") -> DataFrame:
    """Member combinations present in a snapshot but absent from the next one.

    Works on the distinct (snapshot, member) pairs; the successor of a snapshot
    is found over the list of snapshots.
    """
    present = df.select(snapshot, *members).distinct()
    ordered = Window.orderBy(snapshot)
    calendar = (
        df.select(snapshot)
        .distinct()
        .select(snapshot, F.lead(snapshot).over(ordered).alias("successor"))
        .where(F.col("successor").isNotNull())
    )
    expected = present.join(calendar, snapshot).select(F.col("successor").alias(snapshot), *members)
    lost = expected.join(present, [snapshot, *members], "left_anti")
    return _verdict(
        lost,
        "lost_member",
        F.concat_ws("|", *members),
        F.col(snapshot),
        F.lit(0.0),
        1,
        F.lit(True),
    )


def layer_deltas(run_log: DataFrame) -> DataFrame:
    """Row counts of the layers side by side, one row per snapshot."""
    return run_log.groupBy("as_of_date").agg(
        F.max(F.when(F.col("layer") == "bronze", F.col("source_row_count"))).alias("source_rows"),
        F.max(F.when(F.col("layer") == "bronze", F.col("bronze_row_count"))).alias("raw_rows"),
        F.max(F.when(F.col("layer") == "silver", F.col("silver_valid_count"))).alias("valid_rows"),
        F.max(F.when(F.col("layer") == "silver", F.col("silver_rejected_count"))).alias(
            "rejected_rows"
        ),
    ).withColumns(
        {
            "source_to_raw": F.col("raw_rows") - F.col("source_rows"),
            "raw_to_valid": F.col("valid_rows") - F.col("raw_rows"),
        }
    )
