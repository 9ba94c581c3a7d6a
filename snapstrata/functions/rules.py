"""Kinds of validation rules.  Each names the reason and says when a row fails.

A comparison with NULL is unknown, and an unknown rule does not fail a row;
completeness therefore needs its own ``Required`` or ``NotBlank`` rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    reason: str

    def fails(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Required(Rule):
    """Every listed column has a value."""

    columns: tuple[str, ...]

    def fails(self) -> Column:
        return reduce(or_, (F.col(c).isNull() for c in self.columns))


@dataclass(frozen=True)
class NotBlank(Rule):
    column: str

    def fails(self) -> Column:
        c = F.col(self.column)
        return c.isNull() | (c == "")


@dataclass(frozen=True)
class Between(Rule):
    """Inclusive range; either bound may be left out."""

    column: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        return outside(F.col(self.column), self.low, self.high)


@dataclass(frozen=True)
class Differ(Rule):
    """Two columns must not hold the same value."""

    left: str
    right: str

    def fails(self) -> Column:
        return F.col(self.left) == F.col(self.right)


@dataclass(frozen=True)
class AtMostWhen(Rule):
    """``column`` stays at or below ``high`` on rows where ``when_column`` equals a value."""

    when_column: str
    equals: str
    column: str
    high: float

    def fails(self) -> Column:
        return (F.col(self.when_column) == self.equals) & (F.col(self.column) > self.high)


@dataclass(frozen=True)
class OneOf(Rule):
    column: str
    values: tuple[str, ...]

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Absent(Rule):
    """The column is empty, e.g. the kept text of a line the scan could not parse."""

    column: str

    def fails(self) -> Column:
        return F.col(self.column).isNotNull()


def outside(value: Column, low: float | None, high: float | None) -> Column:
    tests = []
    if low is not None:
        tests.append(value < low)
    if high is not None:
        tests.append(value > high)
    if not tests:
        return F.lit(False)
    return reduce(or_, tests)


def required_each(columns: tuple[str, ...]) -> tuple[Rule, ...]:
    """One ``null_<column>`` rule per column, for contracts that want no gaps."""
    return tuple(Required(f"null_{c}", (c,)) for c in columns)
