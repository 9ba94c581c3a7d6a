"""Cheap, reversible cleaning and the derived columns.  Rejects nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.contract import SnapshotContract
from snapstrata.functions import expr as X


def clean(df: DataFrame, contract: SnapshotContract) -> DataFrame:
    """Trim and fix casing."""
    cleaned = {c: F.trim(F.col(c)) for c in contract.trims}
    for name, style in contract.casing.items():
        cleaned[name] = X.recased(cleaned.get(name, F.col(name)), style)
    return df.withColumns(cleaned)


def derive(df: DataFrame, contract: SnapshotContract) -> DataFrame:
    """Add the contract's derived columns and both surrogate keys to cleaned rows."""
    derived = contract.derive()
    out = df.withColumns(derived) if derived else df
    return out.withColumns(
        {
            contract.key_column: X.surrogate_key(contract.business_key, contract.null_token),
            contract.group_column: X.surrogate_key(contract.group_key, contract.null_token),
        }
    )


def standardize(df: DataFrame, contract: SnapshotContract) -> DataFrame:
    return derive(clean(df, contract), contract)
