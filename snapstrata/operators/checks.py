"""Table tests.  Each returns the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.contract import SnapshotContract
from snapstrata.functions.rules import OneOf, outside
from snapstrata.sources.tables import write_partitions


class TableTestError(AssertionError):
    """At least one table test found offending rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULL is not a value)."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the set, with the number of rows that hold them."""
    stray = df.where(~F.col(column).isin(*values))
    return stray.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def accepted_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside an inclusive range; NULL passes, and either bound may be left out."""
    return df.where(F.col(column).isNotNull() & outside(F.col(column), low, high))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent row, and how many child rows carry each.

    Child rows are counted per key first, so a key that dominates the child
    table is a single row by the time the join shuffles.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return used.join(known, fk, "left_anti")


def equal_columns(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two columns hold the same value, e.g. a route back to its origin."""
    return df.where(F.col(left) == F.col(right))


def not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull() | (F.col(column) <= 0))


def premium_out_of_bounds(
    mix: DataFrame, column: str = "business_premium_pct", ceiling: float = 2000
) -> DataFrame:
    """Mark-ups at or below zero, or beyond the ceiling."""
    return mix.where((F.col(column) <= 0) | (F.col(column) > ceiling))


def freshness(
    df: DataFrame,
    column: str,
    now: datetime | str,
    warn_hours: float = 26,
    error_hours: float = 48,
) -> DataFrame:
    """Age of the newest row and its status; a table without rows is an error.

    ``now`` as text is read in the session's time zone, like a column without one.
    """
    newest = df.agg(F.max(column).cast("timestamp").alias("newest"))
    seconds = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("newest")
    age = seconds.cast("double") / F.lit(3600.0)
    return newest.select(
        "newest",
        F.floor(seconds / F.lit(3600)).cast("long").alias("age_hours"),
        F.when(age.isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def failure_counts(tests: Mapping[str, DataFrame]) -> DataFrame:
    """One row per test with its number of offending rows."""
    if not tests:
        raise ValueError("no tests given")
    counted = [
        frame.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("test_name"), "failures"
        )
        for name, frame in tests.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def failing_rows(tests: Mapping[str, DataFrame]) -> DataFrame:
    """All offending rows of all tests in one shape: test name and the row as JSON."""
    shaped = [
        frame.select(F.lit(name).alias("test_name"), F.to_json(F.struct("*")).alias("row"))
        for name, frame in tests.items()
    ]
    return reduce(DataFrame.unionAll, shaped)


def store_failures(tests: Mapping[str, DataFrame], path: str) -> None:
    """Keep the offending rows, one partition per test; a test that passes is emptied."""
    write_partitions(
        failing_rows(tests), path, by=("test_name",), owned=[(name,) for name in tests]
    )


def require_pass(tests: Mapping[str, DataFrame]) -> None:
    """Raise when any test has offending rows."""
    require_none(failure_counts(tests))


def row_failures(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Offending rows per test, for tests that look at one row at a time: one pass for all of them."""
    counted = df.agg(*[F.count_if(bad).alias(f"n{k}") for k, bad in enumerate(conditions.values())])
    told = [F.struct(F.lit(name).alias("test_name"), F.col(f"n{k}").alias("failures")) for k, name in enumerate(conditions)]
    return counted.select(F.inline(F.array(*told)))


# ---- fixed values: staged columns that must be filled ----
FILLED = (
    "flight_quote_sk",
    "quote_group_sk",
    "as_of_date",
    "airline_name",
    "origin_city",
    "destination_city",
    "cabin_class",
    "price_inr",
    "duration_hours",
    "days_to_departure",
)
# ---- end of fixed values ----


def layer_failures(
    valid: DataFrame,
    rejected: DataFrame,
    contract: SnapshotContract,
    staged_quote: Sequence[tuple[str, str, str | None]],
) -> DataFrame:
    """The standing tests over the refined tables and their staged form: test_name, failures.

    Staging renames columns one to one, so a test on a staged column is one on its source.
    Accepted values are those of the contract's rules.
    """
    source = {target: column for column, target, _ in staged_quote}
    conditions = {f"not_null_{name}": F.col(source[name]).isNull() for name in FILLED}
    target = {column: name for name, column in source.items()}
    for rule in contract.rules:
        if isinstance(rule, OneOf):
            conditions[f"accepted_{target[rule.column]}"] = ~F.col(rule.column).isin(*rule.values)
    key = contract.key_column
    repeated = failure_counts({f"unique_{key}": unique(valid, key)})
    reasons = row_failures(rejected, {"not_null_rejection_reason": F.col("rejection_reason").isNull()})
    return row_failures(valid, conditions).unionAll(repeated).unionAll(reasons)


def require_none(failures: DataFrame) -> None:
    """Raise when any test counted an offending row."""
    failed = [r for r in failures.collect() if r["failures"]]
    if failed:
        raise TableTestError(", ".join(f"{r['test_name']}: {r['failures']} rows" for r in failed))


# ---- fixed values: gold columns that must be filled ----
GOLD_FILLED = {
    "fct_flight_price_quote": (
        "flight_quote_sk",
        "as_of_date",
        "route_id",
        "airline_id",
        "cabin_class",
        "lead_time_bucket",
        "price_inr",
        "days_to_departure",
    ),
    "dim_airline": ("airline_id", "airline_name"),
    "dim_route": ("route_id", "origin_city", "destination_city"),
    "mart_route_performance": ("route_id", "quote_count", "avg_price_inr"),
    "mart_booking_leadtime_pricing": ("lead_time_bucket",),
    "mart_airline_cabin_mix": ("airline_name", "route_share_pct"),
    "mart_data_quality_summary": ("rejection_reason", "rejected_pct"),
}
# ---- end of fixed values ----


def gold_failures(
    gold: Mapping[str, DataFrame], airlines: Sequence[str], cabins: Sequence[str], leave_out: Sequence[str] = ()
) -> DataFrame:
    """The counts of ``gold_tests``, with all tests of a table that look at single rows in one pass over it."""
    among = {
        "fct_flight_price_quote": {
            "accepted_fact_cabin_class": ~F.col("cabin_class").isin(*cabins),
            "price_is_positive": F.col("price_inr").isNull() | (F.col("price_inr") <= 0),
        },
        "dim_airline": {"accepted_dim_airline_name": ~F.col("airline_name").isin(*airlines)},
        "dim_route": {
            "range_competing_airlines": outside(F.col("competing_airline_count"), 1, len(airlines)),
            "no_self_routes": F.col("origin_city") == F.col("destination_city"),
        },
        "mart_route_performance": {"accepted_performance_cabin": ~F.col("cabin_class").isin(*cabins)},
    }
    single = {
        table: {
            **{f"not_null_{table}_{column}": F.col(column).isNull() for column in columns},
            **among.get(table, {}),
        }
        for table, columns in GOLD_FILLED.items()
    }
    single = {table: {name: bad for name, bad in tests.items() if name not in leave_out} for table, tests in single.items()}
    covered = {name for tests in among.values() for name in tests}
    grouped = {
        name: test
        for name, test in gold_tests(gold, airlines, cabins).items()
        if not name.startswith("not_null_") and name not in covered and name not in leave_out
    }
    counted = [row_failures(gold[table], conditions) for table, conditions in single.items() if conditions]
    return reduce(DataFrame.unionAll, [*counted, failure_counts(grouped)])


def gold_tests(
    gold: Mapping[str, DataFrame],
    airlines: Sequence[str],
    cabins: Sequence[str],
) -> dict[str, DataFrame]:
    """The standing tests over the gold tables, keyed by name."""
    fact, route, carrier = (
        gold["fct_flight_price_quote"],
        gold["dim_route"],
        gold["dim_airline"],
    )
    performance, curve, mix, quality = (
        gold["mart_route_performance"],
        gold["mart_booking_leadtime_pricing"],
        gold["mart_airline_cabin_mix"],
        gold["mart_data_quality_summary"],
    )
    tests = {
        f"not_null_{table}_{column}": not_null(gold[table], column)
        for table, columns in GOLD_FILLED.items()
        for column in columns
    }
    tests |= {
        "unique_fact_flight_quote_sk": unique(fact, "flight_quote_sk"),
        "unique_dim_airline_airline_id": unique(carrier, "airline_id"),
        "unique_dim_route_route_id": unique(route, "route_id"),
        "relationships_fact_route": relationships(fact, "route_id", route, "route_id"),
        "relationships_fact_airline": relationships(fact, "airline_id", carrier, "airline_id"),
        "relationships_performance_route": relationships(
            performance, "route_id", route, "route_id"
        ),
        "accepted_fact_cabin_class": accepted_values(fact, "cabin_class", cabins),
        "accepted_dim_airline_name": accepted_values(carrier, "airline_name", airlines),
        "accepted_performance_cabin": accepted_values(performance, "cabin_class", cabins),
        "range_competing_airlines": accepted_range(
            route, "competing_airline_count", 1, len(airlines)
        ),
        "grain_route_performance": unique_combination(
            performance, ["as_of_date", "route_id", "cabin_class"]
        ),
        "grain_leadtime": unique_combination(
            curve, ["as_of_date", "route_id", "cabin_class", "lead_time_bucket"]
        ),
        "grain_cabin_mix": unique_combination(mix, ["as_of_date", "route_id", "airline_name"]),
        "premium_is_sane": premium_out_of_bounds(mix),
        "no_self_routes": equal_columns(route, "origin_city", "destination_city"),
        "price_is_positive": not_positive(fact, "price_inr"),
    }
    return tests
