"""Copies of good rows, each broken in one way, to prove that every rule of a contract fires."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.functions import rules as R

FAULT = "fault"


class Fault(NamedTuple):
    """Column values that make a row fail one rule, and the rule's reason."""

    reason: str
    values: Mapping[str, object]


def faults_of(rules: Sequence[R.Rule]) -> list[Fault]:
    """Every way the rules can be broken: each column of a rule, each end of a range.

    Values that have to be equal are taken from what another rule allows, so
    that a fault breaks its own rule only.
    """
    allowed = {r.column: r.values for r in rules if isinstance(r, R.OneOf)}
    out: list[Fault] = []
    for rule in rules:
        match rule:
            case R.Required():
                out += [Fault(rule.reason, {column: None}) for column in rule.columns]
            case R.NotBlank():
                out.append(Fault(rule.reason, {rule.column: None}))
            case R.Between():
                ends = [None if rule.low is None else rule.low - 1, None if rule.high is None else rule.high + 1]
                out += [Fault(rule.reason, {rule.column: end}) for end in ends if end is not None]
            case R.Differ():
                both = {*allowed.get(rule.left, ()), "same"} & {*allowed.get(rule.right, ()), "same"}
                value = min(both - {"same"}, default="same")
                out.append(Fault(rule.reason, {rule.left: value, rule.right: value}))
            case R.AtMostWhen():
                out.append(Fault(rule.reason, {rule.when_column: rule.equals, rule.column: rule.high + 1}))
            case R.OneOf():
                out.append(Fault(rule.reason, {rule.column: "no such value"}))
            case R.Absent():
                out.append(Fault(rule.reason, {rule.column: "something"}))
    return out


def inject_faults(df: DataFrame, order: Sequence[str | Column], faults: Sequence[Fault], label: str = FAULT) -> DataFrame:
    """All rows of ``df`` plus a copy of the k-th row for the k-th fault, with its values.

    ``label`` names the rule that a copy breaks and is NULL on the original rows.
    ``order`` must tell any two rows apart.  Only as many rows as there are
    faults are copied (a top-k), so the numbering below is over that handful.
    """
    donors = df.orderBy(*order).limit(len(faults))
    numbered = donors.withColumn("_fault", F.row_number().over(Window.orderBy(*order)))
    columns = {name: F.col(name) for name in df.columns}
    reason = F.lit(None).cast("string")
    for number, fault in enumerate(faults, start=1):
        chosen = F.col("_fault") == number
        reason = F.when(chosen, fault.reason).otherwise(reason)
        for name, value in fault.values.items():
            columns[name] = F.when(chosen, F.lit(value).cast(df.schema[name].dataType)).otherwise(columns[name])
    broken = numbered.select(*(column.alias(name) for name, column in columns.items()), reason.alias(label))
    return df.withColumn(label, F.lit(None).cast("string")).unionAll(broken)
