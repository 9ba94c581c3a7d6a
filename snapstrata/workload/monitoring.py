"""Registered queries: the monitoring checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from snapstrata.contract import DUPLICATE_REASON
from snapstrata.functions import expr as X
from snapstrata.operators import checks, monitor, reconcile, validate
from snapstrata.operators.standardize import standardize
from snapstrata.plans import marts, star
from snapstrata.plans import refine as R
from snapstrata.sources import audit, fingerprint
from snapstrata.workload.base import (
    FACT_SQL,
    QUOTES,
    SQL,
    TICKET_KEY_SQL,
    TICKETS,
    judged_sql,
    quotes,
    refined,
    refined_sql,
    register,
    stored,
    table,
)
from snapstrata.workload.loading import RUN_LOG_SQL, run_log
from snapstrata.workload.modelling import fact, quality_sql, reasons_per_snapshot
from snapstrata.workload.refining import value_type_drift
from snapstrata.workload.testing import _TESTS_SQL, _standing_tests


def verdict_sql(
    check: str, subject: str, day: str, value: str, threshold: float, breach: str, source: str
) -> str:
    return (
        f"SELECT '{check}' AS check_name, CAST({subject} AS VARCHAR) AS subject, "
        f"CAST({day} AS DATE) AS as_of_date, CAST({value} AS DOUBLE) AS value, "
        f"CAST({threshold} AS DOUBLE) AS threshold, "
        f"CASE WHEN {breach} THEN 'alert' ELSE 'ok' END AS status FROM {source}"
    )


@register(
    "WITH "
    + RUN_LOG_SQL
    + ", short AS (SELECT *, 5 AS lost FROM run_log WHERE as_of_date = DATE '1997-01-01' UNION ALL "
    "SELECT *, 0 FROM run_log WHERE as_of_date <> DATE '1997-01-01') "
    + verdict_sql("reconciliation", "layer", "as_of_date", "lost", 0, "lost > 0", "short")
)
def monitor_reconciliation(spark, sf_dir):
    """The run log, with five rows missing from one snapshot's valid count."""
    log = run_log(spark, sf_dir)
    short = F.when(F.col("as_of_date") == F.lit(date(1997, 1, 1)), 5).otherwise(0)
    valid = (F.col("silver_valid_count") - short).alias("silver_valid_count")
    damaged = log.select(
        "layer",
        "as_of_date",
        "bronze_row_count",
        valid,
        "silver_rejected_count",
        (F.col("reconciled") & (short == 0)).alias("reconciled"),
    )
    return monitor.reconciliation(damaged)


@register(
    verdict_sql("missing_snapshot", "'snapshot'", "d", "0", 1, "true", "(SELECT CAST(unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2002-07-31', INTERVAL 1 DAY)) AS DATE) AS d)")
    + " WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"
)
def monitor_missing_snapshots(spark, sf_dir):
    """Days on which no order came in, from before the first to after the last."""
    orders = table(spark, sf_dir, "orders")
    return monitor.missing_snapshots(orders, "o_orderdate", date(1994, 1, 1), date(2002, 7, 31))


@register(
    verdict_sql("table_test", "test_name", "DATE '2024-01-01'", "failures", 0, "failures > 0", f"({_TESTS_SQL})")
)
def monitor_table_tests(spark, sf_dir):
    counts = checks.failure_counts(_standing_tests(spark, sf_dir))
    return monitor.test_failures(counts, date(2024, 1, 1))


@register(
    "WITH "
    + quality_sql(TICKET_KEY_SQL)
    + ", p AS (SELECT as_of_date, max(rejected_pct) AS pct FROM quality GROUP BY 1) "
    + verdict_sql("rejected_pct", "'snapshot'", "as_of_date", "pct", 94.9, "pct > 94.9", "p")
)
def monitor_rejected_share(spark, sf_dir):
    summary = marts.data_quality_summary(reasons_per_snapshot(spark, sf_dir))
    return monitor.rejected_share(summary, limit=94.9)


@register(
    """WITH v AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2),
m AS (SELECT *, median(n) OVER (PARTITION BY event_type ORDER BY d
        RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS med FROM v) """
    + verdict_sql(
        "volume_vs_median", "event_type", "d", "round(n / med - 1, 6)", 0.2, "abs(n / med - 1) > 0.2", "m"
    )
)
def monitor_volume(spark, sf_dir):
    volumes = monitor.daily_volume(table(spark, sf_dir, "events"), "ts", "event_type")
    return monitor.volume_against_median(volumes)


@register(
    "WITH "
    + judged_sql()
    + """, r AS (SELECT DISTINCT as_of_date, unnest(string_split(own, ',')) AS reason FROM judged
       WHERE own <> '' AND NOT (as_of_date < DATE '1997-01-01' AND own LIKE '%null_flight%')),
f AS (SELECT reason, min(as_of_date) AS d FROM r GROUP BY 1) """
    + verdict_sql(
        "first_seen_reason", "reason", "d", "1", 0, "d > (SELECT min(as_of_date) FROM r)", "f"
    )
)
def monitor_first_seen_reason(spark, sf_dir):
    """First snapshot of each reason; rows without a flight are held back until 1997."""
    judged = validate.judge(standardize(quotes(spark, sf_dir), QUOTES), QUOTES.rules)
    early = F.col("as_of_date") < F.lit(date(1997, 1, 1))
    shown = judged.where(~(early & F.array_contains(validate.REASONS, "null_flight")))
    reasons = shown.select("as_of_date", F.explode(validate.REASONS).alias("reason")).distinct()
    return monitor.first_seen(stored(reasons, "reasons"))


@register(
    "WITH "
    + FACT_SQL
    + """, a AS (SELECT cabin_class, as_of_date, CAST(sum(price_inr) AS DOUBLE) / count(price_inr) AS m FROM fact GROUP BY 1, 2),
l AS (SELECT *, lag(m) OVER (PARTITION BY cabin_class ORDER BY as_of_date) AS before FROM a) """
    + verdict_sql(
        "fare_change", "cabin_class", "as_of_date", "round(m / before - 1, 6)", 0.03, "abs(m / before - 1) > 0.03", "l"
    )
)
def monitor_fare_change(spark, sf_dir):
    fares = monitor.fare_by_cabin(star.fare_cube(fact(spark, sf_dir)))
    return monitor.against_previous(fares, "fare_change", "cabin_class", "mean_fare", 0.03)


_RUNTIME_SQL = """runs AS (
  SELECT event_type AS layer, CAST(ts AS DATE) AS as_of_date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS runtime_seconds
  FROM events GROUP BY 1, 2),
usual AS (SELECT *, avg(runtime_seconds) OVER (PARTITION BY layer ORDER BY as_of_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual FROM runs)"""


@register(
    "WITH "
    + _RUNTIME_SQL
    + " "
    + verdict_sql(
        "runtime_vs_average", "layer", "as_of_date", "round(runtime_seconds / usual, 6)", 1.15,
        "runtime_seconds / usual > 1.15", "usual",
    )
)
def monitor_runtime(spark, sf_dir):
    """Daily event value stands in for the runtime of a layer."""
    runs = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("layer"), F.col("ts").cast("date").alias("as_of_date"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("runtime_seconds"))
        .withColumn("logged_at", F.col("as_of_date").cast("timestamp"))
    )
    return monitor.runtime_against_average(audit.conform(runs, audit.RUN_LOG_SCHEMA), factor=1.15)


_SKEW_KEYS = ("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")


@register(
    " UNION ALL ".join(
        verdict_sql(
            "key_skew", f"'{k}'", "NULL", "round(max(n) * count(*) / sum(n), 6)", 2,
            "max(n) * count(*) / sum(n) > 2",
            f"(SELECT count(*) AS n FROM lineitem GROUP BY {k})",
        )
        for k in _SKEW_KEYS
    )
)
def monitor_key_skew(spark, sf_dir):
    return monitor.key_skew(table(spark, sf_dir, "lineitem"), list(_SKEW_KEYS))


@register(
    """WITH digests AS (
  SELECT o_custkey, md5(concat_ws(chr(31), o_orderpriority)) AS d, CAST(o_orderdate AS DATE) AS day FROM orders),
prints AS (
  SELECT o_custkey, max(day) AS day, md5(concat_ws('|', CAST(count(*) AS VARCHAR),
     CAST(sum(CAST(('0x' || substr(d, 1, 15)) AS BIGINT)) AS VARCHAR),
     CAST(sum(CAST(('0x' || substr(d, 17, 15)) AS BIGINT)) AS VARCHAR))) AS file_hash
  FROM digests GROUP BY 1),
g AS (SELECT file_hash, count(*) AS n, max(day) AS day FROM prints GROUP BY 1 HAVING count(*) > 1) """
    + verdict_sql("repeated_delivery", "file_hash", "day", "n", 1, "true", "g")
)
def monitor_repeated_delivery(spark, sf_dir):
    """Customers whose orders carry the same priorities stand in for re-sent files."""
    orders = table(spark, sf_dir, "orders")
    prints = fingerprint.table_fingerprint(orders, ("o_orderpriority",), by=("o_custkey",))
    days = orders.groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("as_of_date"))
    return monitor.repeated_content(prints.join(days, "o_custkey"))


@register(
    "WITH "
    + refined_sql()
    + """, v AS (SELECT as_of_date, count(*) FILTER (n > 1) AS multi FROM (
    SELECT as_of_date, airline, flight, class, count(*) AS n FROM valid GROUP BY 1, 2, 3, 4) GROUP BY 1),
l AS (SELECT *, lag(multi) OVER (ORDER BY as_of_date) AS before FROM v) """
    + verdict_sql(
        "variant_shift", "'groups'", "as_of_date",
        "round(CASE WHEN before <> 0 THEN CAST(multi AS DOUBLE) / before - 1 END, 6)", 0.5,
        "abs(CASE WHEN before <> 0 THEN CAST(multi AS DOUBLE) / before - 1 END) > 0.5", "l",
    )
)
def monitor_variant_shift(spark, sf_dir):
    """Groups with several fares per snapshot, against the snapshot before."""
    rows = R.valid_rows(refined(spark, sf_dir), QUOTES)
    grouped = rows.withColumn("offer", F.struct("airline", "flight", "class"))
    counts = reconcile.variant_counts(grouped, "as_of_date", "offer")
    named = counts.withColumn("subject_name", F.lit("groups"))
    return monitor.against_previous(
        named, "variant_shift", "subject_name", "multi_variant_quote_groups", 0.5
    )


@register(
    "WITH "
    + FACT_SQL
    + " "
    + " UNION ALL ".join(
        verdict_sql(
            "cardinality", f"'{c}'", "as_of_date", "n", want, f"n <> {want}",
            f"(SELECT as_of_date, count(DISTINCT {c}) AS n FROM fact GROUP BY 1)",
        )
        for c, want in (("route_id", 20), ("airline_name", 6))
    )
)
def monitor_cardinality(spark, sf_dir):
    cube = stored(star.fare_cube(fact(spark, sf_dir)), "cube")
    return monitor.cardinality(cube, {"route_id": 20, "airline_name": 6})


@register(
    "WITH "
    + FACT_SQL
    + """, present AS (SELECT DISTINCT as_of_date, route_name, airline_name, flight_number FROM fact),
calendar AS (SELECT as_of_date, lead(as_of_date) OVER (ORDER BY as_of_date) AS successor
             FROM (SELECT DISTINCT as_of_date FROM present)),
lost AS (SELECT successor, route_name, airline_name, flight_number FROM present JOIN calendar USING (as_of_date)
         WHERE successor IS NOT NULL
         EXCEPT SELECT as_of_date, route_name, airline_name, flight_number FROM present) """
    + verdict_sql(
        "lost_member", "concat_ws('|', route_name, airline_name, flight_number)", "successor", "0", 1, "true", "lost"
    )
)
def monitor_lost_members(spark, sf_dir):
    """Flights a carrier flew on a route in one snapshot but no longer in the next."""
    cube = stored(star.fare_cube(fact(spark, sf_dir)), "cube")
    return monitor.lost_members(cube, ["route_name", "airline_name", "flight_number"])


@register(
    "WITH "
    + refined_sql(TICKET_KEY_SQL)
    + """, c AS (SELECT as_of_date, count(*) AS n, count(*) FILTER (outcome = 'valid') AS good,
       count(*) FILTER (outcome = 'rejected') AS bad FROM refined GROUP BY 1)
SELECT as_of_date, n AS source_rows, n AS raw_rows, good AS valid_rows, bad AS rejected_rows,
       CAST(0 AS BIGINT) AS source_to_raw, good - n AS raw_to_valid FROM c"""
)
def monitor_layer_deltas(spark, sf_dir):
    """Rows per layer side by side, from a log with one entry per layer and snapshot."""
    raw = quotes(spark, sf_dir, ("as_of_date",))
    counted = raw.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("source_row_count"), F.count(F.lit(1)).alias("bronze_row_count")
    )
    bronze = audit.run_log_rows(counted, "bronze")
    silver = run_log(spark, sf_dir)
    return monitor.layer_deltas(bronze.unionByName(silver))


@register(
    verdict_sql(
        "schema_drift", "column_name", "DATE '2024-01-01'", "unparsable_rows", 0, "unparsable_rows > 0", f"({SQL['value_type_drift']})"
    )
)
def monitor_schema_drift(spark, sf_dir):
    """Columns whose values no longer parse as their declared type."""
    return monitor.unparsable_values(value_type_drift(spark, sf_dir), date(2024, 1, 1))


@register(
    "WITH "
    + refined_sql(TICKET_KEY_SQL)
    + """, d AS (SELECT as_of_date, count(*) FILTER (rejection_reason = 'duplicate_business_key') AS dup,
       count(*) AS n FROM refined GROUP BY 1) """
    + verdict_sql("duplicates_removed", "'snapshot'", "as_of_date", "round(dup * 100.0::DOUBLE / n, 2)", 23.5, "round(dup * 100.0::DOUBLE / n, 2) > 23.5", "d")
)
def monitor_duplicate_share(spark, sf_dir):
    """Share of rows that lost the duplicate search, per snapshot."""
    rows = refined(spark, sf_dir, TICKETS)
    lost = F.count_if(F.col(validate.REASON_TEXT) == DUPLICATE_REASON)
    share = rows.groupBy("as_of_date").agg(X.percent(lost, F.count(F.lit(1))).alias("pct"))
    return share.select(
        F.lit("duplicates_removed").alias("check_name"),
        F.lit("snapshot").alias("subject"),
        "as_of_date",
        F.col("pct").alias("value"),
        F.lit(23.5).alias("threshold"),
        F.when(F.col("pct") > 23.5, monitor.ALERT).otherwise(monitor.OK).alias("status"),
    )

