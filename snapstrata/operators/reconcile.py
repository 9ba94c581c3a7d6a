"""Do the numbers of one layer add up to the numbers of the next?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.contract import DUPLICATE_REASON, REJECTED, VALID, SnapshotContract
from snapstrata.functions import expr as X
from snapstrata.operators.validate import OUTCOME, REASON_TEXT


def raw_counts(raw: DataFrame, snapshot: str) -> DataFrame:
    return raw.groupBy(snapshot).agg(F.count(F.lit(1)).alias("bronze_row_count"))


def outcome_counts(refined: DataFrame, snapshot: str) -> DataFrame:
    """Valid, rejected and duplicate rows per snapshot in one pass."""
    return refined.groupBy(snapshot).agg(
        F.count_if(F.col(OUTCOME) == VALID).alias("silver_valid_count"),
        F.count_if(F.col(OUTCOME) == REJECTED).alias("silver_rejected_count"),
        F.count_if(F.col(REASON_TEXT).endswith(DUPLICATE_REASON)).alias("duplicates_removed"),
    )


def _beside(left: DataFrame, right: DataFrame, snapshot: str, how: str) -> DataFrame:
    """Join per snapshot; rows without a snapshot are one as well."""
    other = f"_{snapshot}"
    joined = left.join(right.withColumnRenamed(snapshot, other), F.col(snapshot).eqNullSafe(F.col(other)), how)
    return joined.withColumn(snapshot, F.coalesce(snapshot, other)).drop(other)


def layer_reconciliation(raw: DataFrame, counted: DataFrame, snapshot: str) -> DataFrame:
    """Raw rows against valid + rejected per snapshot; a missing side counts as zero."""
    names = ("bronze_row_count", "silver_valid_count", "silver_rejected_count", "duplicates_removed")
    both = _beside(raw, counted, snapshot, "full").withColumns({n: X.default_to(n, 0) for n in names})
    total = F.col("silver_valid_count") + F.col("silver_rejected_count")
    return both.select(
        snapshot,
        *names,
        X.percent("silver_rejected_count", "bronze_row_count", 4)
        .cast("decimal(9,4)")
        .alias("rejected_pct"),
        (F.col("bronze_row_count") == total).alias("reconciled"),
    )


def breakdown_json(refined: DataFrame, snapshot: str, top: int | None = None) -> DataFrame:
    """The reasons per snapshot as JSON text, most frequent first; all of them unless ``top`` is given.

    Counting comes first; the window and the list then hold one row per reason
    combination, of which the contract's rules allow a fixed number.
    """
    counts = (
        refined.where(F.col(OUTCOME) == REJECTED)
        .groupBy(snapshot, REASON_TEXT)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = Window.partitionBy(snapshot).orderBy(F.desc("n"), F.asc(REASON_TEXT))
    placed = counts.withColumn("place", F.row_number().over(ranked))
    if top is not None:
        placed = placed.where(F.col("place") <= top)
    listed = placed.groupBy(snapshot).agg(
        F.sort_array(F.collect_list(F.struct("place", REASON_TEXT, "n"))).alias("entries")
    )
    pairs = F.transform("entries", lambda e: F.struct(e[REASON_TEXT], e["n"]))
    return listed.select(
        snapshot, F.to_json(F.map_from_entries(pairs)).alias("rejection_reason_breakdown")
    )


def variant_counts(valid: DataFrame, snapshot: str, group: str) -> DataFrame:
    """Groups with more than one valid row, per snapshot."""
    return (
        valid.groupBy(snapshot, group)
        .agg(F.count(F.lit(1)).alias("variants"))
        .groupBy(snapshot)
        .agg(F.count_if(F.col("variants") > 1).alias("multi_variant_quote_groups"))
    )


def snapshot_metrics(
    refined: DataFrame, raw_per_snapshot: DataFrame, contract: SnapshotContract
) -> DataFrame:
    """All run metrics of the refined layer, one row per snapshot."""
    snap = contract.snapshot
    counted = layer_reconciliation(raw_per_snapshot, outcome_counts(refined, snap), snap)
    variants = variant_counts(
        refined.where(F.col(OUTCOME) == VALID), snap, contract.group_column
    )
    return (
        _beside(_beside(counted, variants, snap, "left"), breakdown_json(refined, snap), snap, "left")
        .withColumn("multi_variant_quote_groups", X.default_to("multi_variant_quote_groups", 0))
        .withColumn("rejection_reason_breakdown", X.default_to("rejection_reason_breakdown", "{}"))
    )


# --- table against table (each returns offending rows only) ----------------


def row_counts_differ(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Both row counts where they differ, no row where they agree."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
        for name, frame in zip(names, (left, right), strict=True)
    ]
    sides = [F.max(F.when(F.col("side") == name, F.col("n"))).alias(name) for name in names]
    return counted[0].unionAll(counted[1]).agg(*sides).where(F.col(names[0]) != F.col(names[1]))


def totals_differ(
    fact: DataFrame, mart: DataFrame, by: str, measure: str = "quote_count"
) -> DataFrame:
    """Keys where the mart's summed counts are not the fact's row count."""
    counted = fact.groupBy(by).agg(F.count(F.lit(1)).alias("fact_row_count"))
    summed = mart.groupBy(by).agg(F.sum(measure).alias("mart_quote_count"))
    disagree = ~F.col("fact_row_count").eqNullSafe(F.col("mart_quote_count"))
    return counted.join(summed, by, "full").where(disagree)


def manifest_variance(manifest: DataFrame, fact: DataFrame, snapshot: str) -> DataFrame:
    """Manifest entries whose source row count is not what the fact holds.

    The fact is counted per snapshot before the join, so the join never fans out.
    """
    counted = fact.groupBy(snapshot).agg(F.count(F.lit(1)).alias("landed"))
    landed = X.default_to("landed", 0)
    return (
        manifest.groupBy(snapshot, "source_row_count")
        .agg(F.count(F.lit(1)).alias("entries"))
        .join(counted, snapshot, "left")
        .select(
            snapshot,
            "source_row_count",
            (F.col("entries") * landed).alias("fact_row_count"),
            (F.col("source_row_count") - F.col("entries") * landed).alias("variance"),
        )
        .where(F.col("variance") != 0)
    )
