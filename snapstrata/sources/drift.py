"""Does an incoming schema still match the contract?"""

from __future__ import annotations

import csv
import warnings
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapstrata.functions.expr import parse_as

MISSING, UNEXPECTED, REORDERED, RETYPED = (
    "missing_columns",
    "unexpected_columns",
    "reordered_columns",
    "retyped_columns",
)
REPORT_SCHEMA = StructType(
    [
        StructField("column_name", StringType(), False),
        StructField("drift", StringType(), False),
        StructField("expected", StringType(), True),
        StructField("actual", StringType(), True),
    ]
)


class SchemaDriftError(Exception):
    """The incoming columns do not match the contract."""


class Change(NamedTuple):
    """One difference between incoming and declared columns."""

    column_name: str
    drift: str
    expected: str | None
    actual: str | None


def first_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).first()
    return "" if first is None else first[0].lstrip("\ufeff")


def header_names(line: str, separator: str = ",") -> list[str]:
    """Column names as a header line spells them."""
    return next(csv.reader([line], delimiter=separator)) if line else []


def raw_header(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """Column names as the first line spells them, without byte-order mark."""
    return header_names(first_line(spark, path), separator)


def header_of(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """Column names from the first line, without byte-order mark and padding."""
    return [n.strip() for n in raw_header(spark, path, separator)]


def column_changes(
    actual: Sequence[tuple[str, str]], expected: Sequence[tuple[str, str]]
) -> list[Change]:
    """Compare (name, type) lists by name, type and position in one go.

    A name that comes a second time is unexpected.  Positions are only compared
    where both sides hold the same names.
    """
    wanted = {name: (place, kind) for place, (name, kind) in enumerate(expected)}
    changes, seen, moved = [], set(), []
    for place, (name, kind) in enumerate(actual):
        if name not in wanted or name in seen:
            changes.append(Change(name, UNEXPECTED, None, kind))
            continue
        seen.add(name)
        right_place, right_kind = wanted[name]
        if kind != right_kind:
            changes.append(Change(name, RETYPED, right_kind, kind))
        if place != right_place:
            moved.append(Change(name, REORDERED, str(right_place), str(place)))
    changes += [Change(n, MISSING, kind, None) for n, (_, kind) in wanted.items() if n not in seen]
    return changes if {c.drift for c in changes} & {MISSING, UNEXPECTED} else changes + moved


def gate_header(names: Sequence[str], declared: StructType, *, allow_reorder: bool = True) -> list[Change]:
    """Stop on missing or unexpected columns; a changed order only warns when allowed."""
    texts = [(name, "string") for name in names]
    changes = column_changes(texts, [(name, "string") for name in declared.fieldNames()])
    told = "; ".join(f"{c.drift}: {c.column_name}" for c in changes)
    if any(c.drift != REORDERED or not allow_reorder for c in changes):
        raise SchemaDriftError(f"the header is not the contract's: {told}")
    if changes:
        warnings.warn(f"the header is in another order: {told}", stacklevel=2)
    return changes


def drift_report(spark: SparkSession, actual: StructType, expected: StructType) -> DataFrame:
    """One row per difference in name, type or position."""
    sides = [[(f.name, f.dataType.simpleString()) for f in side.fields] for side in (actual, expected)]
    return spark.createDataFrame(column_changes(*sides), REPORT_SCHEMA)


def value_drift(df: DataFrame, expected: StructType) -> DataFrame:
    """Per contract column: rows whose text does not parse as the contract's type.

    Schema drift seen in the values.  One pass over the table, one row per
    column in the result.
    """
    fields = [f for f in expected.fields if f.name in df.columns]
    bad = [
        F.count_if(
            F.col(f.name).isNotNull()
            & parse_as(F.col(f.name).cast("string"), f.dataType.simpleString()).isNull()
        ).alias(f"bad_{i}")
        for i, f in enumerate(fields)
    ]
    filled = [F.count(f.name).alias(f"filled_{i}") for i, f in enumerate(fields)]
    totals = df.agg(*bad, *filled)
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected"),
                F.col(f"filled_{i}").alias("filled_rows"),
                F.col(f"bad_{i}").alias("unparsable_rows"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return totals.select(F.inline(rows))
