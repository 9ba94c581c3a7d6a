"""Combining a target with a batch of newer rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_insert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch does not bring, plus the whole batch."""
    untouched = target.join(batch.select(*key), list(key), "left_anti")
    return untouched.select(*batch.columns).unionByName(batch)


def upsert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Matched rows take the ``update`` columns from the batch; other batch rows are added.

    The key must be unique on both sides, which also keeps the join free of hot keys.
    """
    old, new = target.alias("old"), batch.alias("new")
    condition = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]
    matched_key = F.col(f"new.{key[0]}").isNotNull()
    is_old = F.col(f"old.{key[0]}").isNotNull()
    columns = []
    for name in target.columns:
        was, becomes = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in key:
            value = F.coalesce(was, becomes)
        elif name in update:
            value = F.when(matched_key, becomes).otherwise(was)
        else:
            value = F.when(is_old, was).otherwise(becomes)
        columns.append(value.alias(name))
    return old.join(new, condition, "full").select(*columns)


def partition_values(df: DataFrame, column: str) -> list:
    """Distinct snapshot values.

    Collected on purpose: there is one per calendar day, and as literals they
    prune partitions and need no join.  None, for rows without a snapshot, comes last.
    """
    found = [r[0] for r in df.select(column).distinct().collect()]
    return sorted(v for v in found if v is not None) + [None] * (None in found)


def in_snapshots(column: str, values: Sequence) -> Column:
    """Does the row belong to one of the snapshots?  None stands for rows without one; never NULL."""
    known = [v for v in values if v is not None]
    among = F.coalesce(F.col(column).isin(*known), F.lit(False)) if known else F.lit(False)
    return among | F.col(column).isNull() if None in values else among


def repeated_keys(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    return batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def replace_snapshots(target: DataFrame, batch: DataFrame, snapshot: str) -> DataFrame:
    """The batch is the whole truth for its snapshots; other snapshots stay."""
    untouched = target.where(~in_snapshots(snapshot, partition_values(batch, snapshot)))
    return untouched.select(*batch.columns).unionByName(batch)


def at_or_after(df: DataFrame, column: str, watermark: object) -> DataFrame:
    """Rows from the last loaded value on; inclusive, so a same-day rerun corrects itself."""
    if watermark is None:
        return df
    return df.where(F.col(column) >= F.lit(watermark))


def arrived_since(
    df: DataFrame, snapshot: str, arrival: str, last_arrival: object
) -> DataFrame:
    """All rows of every snapshot that received rows after ``last_arrival``.

    Unlike a watermark on the snapshot date this also picks up a file that
    arrives late for an old snapshot.
    """
    if last_arrival is None:
        return df
    fresh = df.where(F.col(arrival) > F.lit(last_arrival))
    return df.where(in_snapshots(snapshot, partition_values(fresh, snapshot)))
