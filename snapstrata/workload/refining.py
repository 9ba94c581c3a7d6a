"""Registered queries: cleaning, rules, duplicates, reasons, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StructField, StructType

from snapstrata.contracts.flights import CATEGORICAL_GAPS, QUOTE_COLUMNS
from snapstrata.functions import expr as X
from snapstrata.operators import dedupe, reconcile, validate
from snapstrata.operators.faults import faults_of, inject_faults
from snapstrata.operators.standardize import standardize
from snapstrata.plans import refine as R
from snapstrata.sources.drift import value_drift
from snapstrata.workload.base import (
    GAP_CASES,
    LINE_ID,
    QUOTE_COLUMNS_SQL,
    QUOTE_KEY_SQL,
    QUOTES,
    QUOTES_SQL,
    REASON_CASES,
    STD_SQL,
    TICKET_KEY_SQL,
    TICKETS,
    judged_sql,
    quotes,
    reasons_sql,
    refined,
    refined_sql,
    register,
    table,
)

LINE_ID_SQL = "order_key, line_number, part_key, supp_key, list_price, shipped"


@register("WITH " + STD_SQL.format(key=QUOTE_KEY_SQL) + f" SELECT {QUOTE_COLUMNS_SQL} FROM std")
def standardize_quotes(spark, sf_dir):
    return standardize(quotes(spark, sf_dir), QUOTES).select(*QUOTE_COLUMNS)


@register(
    "WITH "
    + QUOTES_SQL
    + f""" SELECT {LINE_ID_SQL},
  md5(concat_ws('||', flight, source_city, arrival_time)) AS key_skipping_nulls,
  md5(coalesce(flight, '<null>') || '||' || coalesce(source_city, '<null>') || '||'
      || coalesce(arrival_time, '<null>')) AS key_marking_nulls
  FROM quotes"""
)
def null_handling_in_keys(spark, sf_dir):
    parts = ("flight", "source_city", "arrival_time")
    rows = quotes(spark, sf_dir, LINE_ID + parts)
    cleaned = rows.withColumn("flight", F.upper(F.trim("flight")))
    return cleaned.select(
        *LINE_ID,
        X.surrogate_key(parts).alias("key_skipping_nulls"),
        X.surrogate_key(parts, null_token="<null>").alias("key_marking_nulls"),
    )


@register(
    "WITH " + judged_sql() + f" SELECT {LINE_ID_SQL}, own AS reasons, own = '' AS is_valid FROM judged"
)
def rule_reasons(spark, sf_dir):
    judged = validate.judge(standardize(quotes(spark, sf_dir), QUOTES), QUOTES.rules)
    return judged.select(
        *LINE_ID, F.concat_ws(",", validate.REASONS).alias("reasons"), validate.IS_VALID
    )


@register("WITH " + refined_sql() + f" SELECT {QUOTE_COLUMNS_SQL} FROM valid")
def valid_quotes(spark, sf_dir):
    return R.accepted_rows(quotes(spark, sf_dir), QUOTES)


@register("WITH " + refined_sql() + f" SELECT {QUOTE_COLUMNS_SQL}, rejection_reason FROM rejected")
def rejected_quotes(spark, sf_dir):
    return R.rejected_rows(refined(spark, sf_dir), QUOTES)


@register("WITH " + refined_sql(TICKET_KEY_SQL) + f" SELECT {QUOTE_COLUMNS_SQL} FROM valid")
def valid_tickets(spark, sf_dir):
    return R.accepted_rows(quotes(spark, sf_dir), TICKETS)


@register(
    "WITH "
    + refined_sql(TICKET_KEY_SQL)
    + f" SELECT {QUOTE_COLUMNS_SQL}, rejection_reason FROM rejected"
)
def rejected_tickets(spark, sf_dir):
    return R.rejected_rows(refined(spark, sf_dir, TICKETS), TICKETS)


@register(
    "WITH "
    + judged_sql(TICKET_KEY_SQL)
    + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_key, line_number
     ORDER BY (own = '') DESC, _ingested_at DESC, order_key, line_number, part_key, supp_key, list_price) AS place
  FROM judged)
SELECT coalesce(CASE WHEN place > 1 AND own <> '' THEN own || ',duplicate_business_key'
                     WHEN place > 1 THEN 'duplicate_business_key'
                     ELSE nullif(own, '') END, 'accepted') AS reason,
       count(*) AS n
FROM ranked GROUP BY 1"""
)
def tickets_preferring_valid(spark, sf_dir):
    """Duplicates resolved in favour of valid rows; losers keep their own reasons."""
    contract = TICKETS.with_options(prefer_valid=True, keep_duplicate_reasons=True)
    reason = F.coalesce(validate.REASON_TEXT, F.lit("accepted")).alias("reason")
    return refined(spark, sf_dir, contract).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


LINE_ORDER = (
    ("l_shipdate", "desc"),
    ("l_partkey", "asc"),
    ("l_suppkey", "asc"),
    ("l_extendedprice", "asc"),
)
_LINES_RANKED = """SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem)"""


@register(_LINES_RANKED + " WHERE place = 1")
def dedupe_kept(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedupe.keep_first(lines, ("l_orderkey", "l_linenumber"), LINE_ORDER)


@register(_LINES_RANKED + " WHERE place > 1")
def dedupe_dropped(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedupe.deduplicate(lines, ("l_orderkey", "l_linenumber"), LINE_ORDER)[1]


@register(
    """SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linenumber
    ORDER BY l_shipdate DESC, l_orderkey, l_partkey, l_suppkey, l_extendedprice) = 1 AS first_of_group
  FROM lineitem"""
)
def dedupe_hot_keys(spark, sf_dir):
    """Twenty-one keys share all lines, so every key is hot."""
    lines = table(spark, sf_dir, "lineitem")
    order = (("l_shipdate", "desc"), ("l_orderkey", "asc")) + LINE_ORDER[1:]
    return dedupe.mark_winners(lines, ("l_returnflag", "l_linenumber"), order, flag="first_of_group")


@register(
    """SELECT l_returnflag, l_linestatus, l_linenumber,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linestatus, l_linenumber) = 1 AS first_of_flag
  FROM (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem)"""
)
def dedupe_tied_hot_keys(spark, sf_dir):
    """Three keys share all lines, and most rows equal others in every column: the best row has thousands of copies."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    order = (("l_linestatus", "asc"), ("l_linenumber", "asc"))
    return dedupe.mark_winners(lines, ("l_returnflag",), order, flag="first_of_flag")


@register(
    "WITH "
    + refined_sql()
    + """ SELECT rejection_reason, count(*) AS n FROM rejected GROUP BY 1"""
)
def reason_breakdown(spark, sf_dir):
    """All reason combinations (the report the run log keeps)."""
    return validate.reason_breakdown(R.rejected_rows(refined(spark, sf_dir), QUOTES))


@register(
    "WITH "
    + judged_sql()
    + """ SELECT reason, count(*) AS n
  FROM (SELECT unnest(string_split(own, ',')) AS reason FROM judged WHERE own <> '') GROUP BY 1"""
)
def reason_exploded(spark, sf_dir):
    judged = validate.judge(standardize(quotes(spark, sf_dir), QUOTES), QUOTES.rules)
    return validate.reason_counts(judged)


@register(
    "WITH "
    + QUOTES_SQL
    + f""" SELECT reason, count(*) AS n
  FROM (SELECT unnest(string_split({reasons_sql(REASON_CASES + GAP_CASES)}, ',')) AS reason FROM quotes)
  WHERE reason <> '' GROUP BY 1"""
)
def strict_categorical_reasons(spark, sf_dir):
    """The opt-in rules that also reject NULL categoricals."""
    rows = standardize(quotes(spark, sf_dir), QUOTES)
    return validate.reason_counts(validate.judge(rows, QUOTES.rules + CATEGORICAL_GAPS))


@register(
    "WITH "
    + refined_sql(TICKET_KEY_SQL)
    + """, counted AS (
  SELECT as_of_date, count(*) AS total, count(*) FILTER (outcome = 'valid') AS good,
         count(*) FILTER (outcome = 'rejected') AS bad,
         count(*) FILTER (rejection_reason = 'duplicate_business_key') AS dup
  FROM refined GROUP BY 1),
raw AS (SELECT as_of_date, count(*) AS n FROM quotes GROUP BY 1)
SELECT raw.as_of_date, raw.n AS bronze_row_count, good AS silver_valid_count,
       bad AS silver_rejected_count, dup AS duplicates_removed,
       CAST(round(bad * 100.0::DOUBLE / raw.n, 4) AS DECIMAL(9,4)) AS rejected_pct,
       raw.n = good + bad AS reconciled
FROM raw JOIN counted USING (as_of_date)"""
)
def reconcile_layers(spark, sf_dir):
    raw = reconcile.raw_counts(quotes(spark, sf_dir, ("as_of_date",)), "as_of_date")
    counted = reconcile.outcome_counts(refined(spark, sf_dir, TICKETS), "as_of_date")
    return reconcile.layer_reconciliation(raw, counted, "as_of_date")


@register(
    """SELECT l_orderkey, l_linenumber, count(*) AS variants FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1"""
)
def multi_variant_groups(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedupe.multi_variant_groups(lines, ("l_orderkey", "l_linenumber"))


#: each rule of the contract broken in each of its ways
FAULTS = faults_of(QUOTES.rules)


def _fault_sql() -> str:
    kinds = {"price": "DECIMAL(12,2)", "duration": "DOUBLE", "days_left": "INTEGER"}
    columns = []
    for name in sorted({n for f in FAULTS for n in f.values}):
        cases = " ".join(
            f"WHEN {k} THEN CAST({'NULL' if f.values[name] is None else repr(str(f.values[name]))} AS {kinds.get(name, 'VARCHAR')})"
            for k, f in enumerate(FAULTS, start=1)
            if name in f.values
        )
        columns.append(f"CASE k {cases} ELSE {name} END AS {name}")
    return ", ".join(columns)


_FAULT_NAMES_SQL = " ".join(f"WHEN {k} THEN '{f.reason}'" for k, f in enumerate(FAULTS, start=1))


@register(
    "WITH "
    + QUOTES_SQL
    + f""", donors AS (
  SELECT *, row_number() OVER (ORDER BY {LINE_ID_SQL}) AS k FROM quotes QUALIFY k <= {len(FAULTS)}),
broken AS (
  SELECT * EXCLUDE (k) REPLACE ({_fault_sql()}), CASE k {_FAULT_NAMES_SQL} END AS fault FROM donors),
mixed AS (SELECT *, CAST(NULL AS VARCHAR) AS fault FROM quotes UNION ALL BY NAME SELECT * FROM broken)
SELECT coalesce(fault, 'original') AS origin, {reasons_sql(REASON_CASES)} AS reasons, count(*) AS n
FROM mixed GROUP BY ALL"""
)
def fault_injection(spark, sf_dir):
    """Broken copies of real rows next to all original rows, and the reasons both get."""
    mixed = inject_faults(quotes(spark, sf_dir), LINE_ID, FAULTS)
    judged = validate.judge(standardize(mixed, QUOTES), QUOTES.rules)
    origin = F.coalesce("fault", F.lit("original"))
    reasons = F.concat_ws(",", validate.REASONS)
    return judged.groupBy(origin.alias("origin"), reasons.alias("reasons")).agg(
        F.count(F.lit(1)).alias("n")
    )


TEXT_LINE = StructType(
    [
        StructField("price_text", DecimalType(12, 2)),
        StructField("shipped_text", DateType()),
        StructField("line_text", IntegerType()),
    ]
)


@register(
    """WITH t AS (
  SELECT CASE WHEN l_discount = 0.05 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS p,
         CASE WHEN l_tax = 0.03 THEN 'soon' WHEN l_tax <> 0.04 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS d,
         CAST(l_linenumber AS VARCHAR) AS l FROM lineitem)
SELECT 'price_text' AS column_name, 'decimal(12,2)' AS expected, count(p) AS filled_rows,
       count(*) FILTER (p IS NOT NULL AND TRY_CAST(p AS DECIMAL(12,2)) IS NULL) AS unparsable_rows FROM t
UNION ALL SELECT 'shipped_text', 'date', count(d), count(*) FILTER (d IS NOT NULL AND TRY_CAST(d AS DATE) IS NULL) FROM t
UNION ALL SELECT 'line_text', 'int', count(l), count(*) FILTER (l IS NOT NULL AND TRY_CAST(l AS INTEGER) IS NULL) FROM t"""
)
def value_type_drift(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    shipped = F.col("l_shipdate").cast("date").cast("string")
    text = lines.select(
        F.when(F.col("l_discount") == 0.05, "n/a").otherwise(price).alias("price_text"),
        F.when(F.col("l_tax") == 0.03, "soon")
        .when(F.col("l_tax") != 0.04, shipped)
        .alias("shipped_text"),
        F.col("l_linenumber").cast("string").alias("line_text"),
    )
    return value_drift(text, TEXT_LINE)
