"""Scalar expressions as plain functions from Columns to Columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapstrata.contract import LeadTimeBands

KEY_SEPARATOR = "||"
_CASINGS = {"title": F.initcap, "lower": F.lower, "upper": F.upper}


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text -----------------------------------------------------------------


def recased(column: Column | str, style: str) -> Column:
    return _CASINGS[style](_c(column))


def joined_label(separator: str, *columns: Column | str) -> Column:
    return F.concat_ws(separator, *[_c(c) for c in columns])


def display_name(column: Column | str) -> Column:
    """Underscores become blanks."""
    return F.replace(_c(column), F.lit("_"), F.lit(" "))


def unordered_pair(left: str, right: str, link: str = "<->") -> Column:
    """The same label for (a, b) and (b, a); NULL when either is NULL."""
    a, b = F.col(left), F.col(right)
    return F.when(a < b, F.concat(a, F.lit(link), b)).otherwise(F.concat(b, F.lit(link), a))


def label_code(column: Column | str, codes: Mapping[str, int]) -> Column:
    """The number that stands for a label; unknown labels give NULL."""
    known = F.lit(None).cast("int")
    for label, code in codes.items():
        known = F.when(_c(column) == label, code).otherwise(known)
    return known


# --- keys -----------------------------------------------------------------


def surrogate_key(columns: Sequence[str], null_token: str | None = None) -> Column:
    """md5 over the columns as text.

    With no ``null_token`` a NULL part is left out, so (a, NULL, b) and (a, b)
    share a key; pass a token to keep them apart.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def strict_key(*columns: Column | str) -> Column:
    """md5 over the joined text; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(_c(c))
    return F.md5(F.concat(*parts))


# --- numbers --------------------------------------------------------------


def round_binary(value: Column, places: int) -> Column:
    """Round a double the way SQL engines on binary doubles do.

    The scaled value is rounded half away from zero.  ``F.round`` works on the
    shortest decimal text instead and differs on values such as 1.005.
    """
    scale = F.lit(float(10**places))
    return F.round(value * scale, 0) / scale


def safe_divide(numerator: Column | str, denominator: Column | str, places: int = 2) -> Column:
    """Rounded double quotient; NULL when the denominator is NULL or zero."""
    n, d = _c(numerator), _c(denominator)
    quotient = F.when(d != 0, n.cast("double") / d.cast("double"))
    return round_binary(quotient, places)


def percent(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    return safe_divide(_c(part).cast("double") * F.lit(100.0), whole, places)


def money(value: Column, places: int = 2) -> Column:
    """A double amount as decimal(14, places)."""
    return round_binary(value.cast("double"), places).cast(f"decimal(14,{places})")


def exact_money(value: Column, places: int = 2) -> Column:
    """A decimal amount as decimal(14, places), rounded half up."""
    return F.round(value, places).cast(f"decimal(14,{places})")


def mean_of(total: Column, count: Column) -> Column:
    """Mean as a double from an exact decimal total with two places.

    Decimal totals do not depend on the order in which tasks finish, so the
    mean is the same on every run and under any partitioning.
    """
    return F.when(
        count > 0, (total * F.lit(100)).cast("double") / (count.cast("double") * F.lit(100.0))
    )


def minutes_from_hours(hours: Column | str) -> Column:
    return F.round(_c(hours) * 60).cast("int")


def default_to(column: Column | str, value: object) -> Column:
    return F.coalesce(_c(column), F.lit(value))


def parse_as(column: Column | str, type_name: str) -> Column:
    """Cast untrusted text; text that does not parse gives NULL."""
    return _c(column).try_cast(type_name)


# --- lead-time bands ------------------------------------------------------


def lead_time_label(days: Column | str, bands: LeadTimeBands) -> Column:
    return _banded(_c(days), [(label, high) for label, _, _, high in bands.rows()])


def lead_time_rank(days: Column | str, bands: LeadTimeBands) -> Column:
    return _banded(_c(days), [(ordinal, high) for _, ordinal, _, high in bands.rows()])


def _banded(days: Column, steps: list[tuple[object, int | None]]) -> Column:
    """First step whose upper bound holds the value; the open step takes the rest."""
    chain: Column | None = None
    for value, high in steps:
        if high is None:
            break
        chain = F.when(days <= high, F.lit(value)) if chain is None else chain.when(
            days <= high, F.lit(value)
        )
    last = F.lit(steps[-1][0])
    return last if chain is None else chain.otherwise(last)


# --- whole-frame helpers --------------------------------------------------


def casts(mapping: Iterable[tuple[str, str, str | None]]) -> list[Column]:
    """Columns for a rename-and-cast projection: (source, target, type or None)."""
    out = []
    for source, target, type_name in mapping:
        c = F.col(source)
        out.append((c.cast(type_name) if type_name else c).alias(target))
    return out
