"""Registered queries: profiling of the order lines."""

from __future__ import annotations

from itertools import combinations

from snapstrata.operators import profile
from snapstrata.workload.base import QUOTES_SQL, quotes, register, stored, table

SHAPE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_returnflag",
    "l_linestatus",
)


@register(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"
        for c in SHAPE_COLUMNS
    )
)
def profile_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "lineitem"), SHAPE_COLUMNS)


_GAPPY = ("source_city", "arrival_time", "flight", "duration", "days_left")


@register(
    "WITH "
    + QUOTES_SQL
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({x}) AS VARCHAR) AS min_value, "
        f"CAST(max({x}) AS VARCHAR) AS max_value FROM quotes"
        for c in _GAPPY
        for x in [c if c != "flight" else "' ' || lower(flight)"]
    )
)
def profile_quotes_with_gaps(spark, sf_dir):
    return profile.shape(quotes(spark, sf_dir, _GAPPY), _GAPPY)


_LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)


@register(
    f"""SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
  CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(_LINE_COLUMNS)})"""
)
def profile_duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"), _LINE_COLUMNS)


CANDIDATES = {
    "order": ("l_orderkey",),
    "order_line": ("l_orderkey", "l_linenumber"),
    "order_line_part": ("l_orderkey", "l_linenumber", "l_partkey"),
    "order_line_part_supplier": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
}


@register(
    " UNION ALL ".join(
        f"SELECT '{n}' AS candidate, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys, "
        f"CAST(sum(n - 1) AS BIGINT) AS rows_dropped "
        f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(c)})"
        for n, c in CANDIDATES.items()
    )
)
def profile_candidate_keys(spark, sf_dir):
    return profile.candidate_keys(table(spark, sf_dir, "lineitem"), CANDIDATES)


_ATTRIBUTES = ("l_partkey", "l_quantity", "l_returnflag", "l_shipdate")


@register(
    "WITH g AS (SELECT "
    + ", ".join(f"count(DISTINCT {a}) > 1 AS d{i}" for i, a in enumerate(_ATTRIBUTES))
    + " FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, count(*) AS repeated_keys, "
        f"count(*) FILTER (d{i}) AS keys_that_differ FROM g"
        for i, a in enumerate(_ATTRIBUTES)
    )
)
def profile_key_differences(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.differing_attributes(lines, ("l_orderkey", "l_linenumber"), _ATTRIBUTES)


@register(
    """SELECT group_size, count(*) AS group_count FROM (
  SELECT count(*) AS group_size FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY 1"""
)
def profile_group_sizes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.group_size_histogram(lines, ("l_orderkey", "l_linenumber"))


@register(
    """SELECT l_returnflag, l_linestatus, count(*) AS row_count, min(l_extendedprice) AS min_value,
  max(l_extendedprice) AS max_value, round(avg(CAST(l_extendedprice AS DECIMAL(18,2))), 4) AS mean_value
  FROM lineitem GROUP BY 1, 2"""
)
def profile_by_category(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.measure_by_category(lines, ("l_returnflag", "l_linestatus"), "l_extendedprice")


_KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
_SUBSETS = [c for size in range(1, len(_KEY_COLUMNS) + 1) for c in combinations(_KEY_COLUMNS, size)]


def _bits(columns):
    return sum(1 << _KEY_COLUMNS.index(c) for c in columns)


@register(
    "WITH sizes AS ("
    + " UNION ALL ".join(
        f"SELECT '{','.join(c)}' AS key_columns, {len(c)} AS n_columns, {_bits(c)} AS bits, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM lineitem)) = (SELECT count(*) FROM lineitem) AS tells"
        for c in _SUBSETS
    )
    + """)
SELECT key_columns, n_columns FROM sizes s
WHERE tells AND NOT EXISTS (SELECT 1 FROM sizes t WHERE t.tells AND t.bits <> s.bits AND t.bits & s.bits = t.bits)"""
)
def profile_minimal_keys(spark, sf_dir):
    """Which combinations of six columns tell all order lines apart, none of whose parts does."""
    return profile.minimal_keys(table(spark, sf_dir, "lineitem"), _KEY_COLUMNS)
