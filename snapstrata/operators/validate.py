"""Judge every row against every rule in one pass, without a shuffle."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.contract import DUPLICATE_REASON, REJECTED, VALID, SnapshotContract
from snapstrata.functions.rules import Rule

REASONS, IS_VALID, OUTCOME, REASON_TEXT = (
    "rejection_reasons",
    "is_valid",
    "outcome",
    "rejection_reason",
)


def judge(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Add ``is_valid`` and the array of all failed reasons, in rule order.

    The array is only assembled on rows that fail something.
    """
    fails = [r.fails() for r in rules]
    failed = reduce(or_, (F.coalesce(f, F.lit(False)) for f in fails), F.lit(False))
    none = F.array().cast("array<string>")
    named = [F.when(f, F.lit(r.reason)) for f, r in zip(fails, rules, strict=True)]
    reasons = F.array_compact(F.array(*named)) if rules else none
    judged = df.withColumn(IS_VALID, ~failed)
    return judged.withColumn(REASONS, F.when(F.col(IS_VALID), none).otherwise(reasons))


def settle(df: DataFrame, contract: SnapshotContract, kept: str) -> DataFrame:
    """Combine the rule verdicts with the duplicate verdict into one outcome per row.

    ``rejection_reason`` is NULL on valid rows.  A losing duplicate is rejected
    as a duplicate whatever its own failures were, unless the contract keeps them.
    """
    own, lost = F.col(REASONS), ~F.col(kept)
    duplicate = F.array(F.lit(DUPLICATE_REASON))
    if contract.keep_duplicate_reasons:
        duplicate = F.concat(own, duplicate)
    reasons = F.when(lost, duplicate).otherwise(own)
    accepted = F.col(kept) & F.col(IS_VALID)
    return df.withColumns(
        {
            REASONS: reasons,
            OUTCOME: F.when(accepted, F.lit(VALID)).otherwise(F.lit(REJECTED)),
            REASON_TEXT: F.when(~accepted, F.concat_ws(",", reasons)),
        }
    ).drop(IS_VALID, kept)


def reason_breakdown(rejected: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per combined reason text, most frequent first; all of them unless ``top`` is given."""
    counts = rejected.groupBy(REASON_TEXT).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc(REASON_TEXT))
    return ordered if top is None else ordered.limit(top)


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rows per single reason; a row with two reasons counts under both."""
    return (
        judged.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
