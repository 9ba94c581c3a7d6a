"""Registered queries: table tests.  Bounds are set so that the tests find rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstrata.operators import checks, reconcile
from snapstrata.plans import marts, star
from snapstrata.session import work_area
from snapstrata.workload.base import (
    FACT_SQL,
    LINE_ID,
    QUOTES_SQL,
    STAGED_SQL,
    quotes,
    register,
    stored,
    table,
)
from snapstrata.workload.modelling import MIX_SQL, PERFORMANCE_SQL, fact, staged

LINE_ID_SQL = "order_key, line_number, part_key, supp_key, list_price, shipped"


@register("WITH " + QUOTES_SQL + f" SELECT {LINE_ID_SQL}, arrival_time FROM quotes WHERE arrival_time IS NULL")
def check_not_null(spark, sf_dir):
    return checks.not_null(quotes(spark, sf_dir, LINE_ID + ("arrival_time",)), "arrival_time")


@register("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register(
    "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
def check_unique_combination(spark, sf_dir):
    return checks.unique_combination(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_partkey"))


@register(
    """SELECT o_orderpriority, count(*) AS n FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1"""
)
def check_accepted_values(spark, sf_dir):
    allowed = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", allowed)


@register(
    "WITH " + QUOTES_SQL + f" SELECT {LINE_ID_SQL}, days_left FROM quotes WHERE days_left < 0 OR days_left > 365"
)
def check_accepted_range(spark, sf_dir):
    rows = quotes(spark, sf_dir, LINE_ID + ("days_left",))
    return checks.accepted_range(rows, "days_left", 0, 365)


@register("SELECT * FROM lineitem WHERE l_quantity > 45")
def check_upper_bound_only(spark, sf_dir):
    return checks.accepted_range(table(spark, sf_dir, "lineitem"), "l_quantity", high=45)


@register(
    """SELECT l_orderkey, count(*) AS n FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1"""
)
def check_relationships(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return checks.relationships(
        table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey"
    )


@register(
    "WITH "
    + QUOTES_SQL
    + f" SELECT {LINE_ID_SQL}, source_city, destination_city FROM quotes WHERE source_city = destination_city"
)
def check_self_route(spark, sf_dir):
    rows = quotes(spark, sf_dir, LINE_ID + ("source_city", "destination_city"))
    return checks.equal_columns(rows, "source_city", "destination_city")


@register(
    "WITH "
    + QUOTES_SQL
    + f""", t AS (SELECT {LINE_ID_SQL}, price - 20000 AS margin FROM quotes)
  SELECT * FROM t WHERE margin IS NULL OR margin <= 0"""
)
def check_price_positive(spark, sf_dir):
    rows = quotes(spark, sf_dir, LINE_ID + ("price",))
    margin = (F.col("price") - 20000).cast("decimal(13,2)").alias("margin")
    return checks.not_positive(rows.select(*LINE_ID, margin), "margin")


@register(
    "WITH "
    + FACT_SQL
    + ", "
    + MIX_SQL
    + """ SELECT as_of_date, route_id, airline_name, avg_economy_price_inr, avg_business_price_inr,
  business_premium_pct FROM mix WHERE business_premium_pct <= 0 OR business_premium_pct > 2000"""
)
def check_premium(spark, sf_dir):
    mix = marts.carrier_cabin_mix(star.fare_cube(fact(spark, sf_dir)))
    return checks.premium_out_of_bounds(mix).select(
        "as_of_date",
        "route_id",
        "airline_name",
        "avg_economy_price_inr",
        "avg_business_price_inr",
        "business_premium_pct",
    )


@register(
    "WITH "
    + STAGED_SQL
    + """ SELECT a.n AS staging_row_count, b.n AS fact_row_count
  FROM (SELECT count(*) AS n FROM quotes) a CROSS JOIN (SELECT count(*) AS n FROM stg) b WHERE a.n <> b.n"""
)
def recon_counts(spark, sf_dir):
    """Raw lines against accepted quotes, which differ by what was rejected."""
    raw = quotes(spark, sf_dir, ("order_key",))
    names = ("staging_row_count", "fact_row_count")
    return reconcile.row_counts_differ(raw, staged(spark, sf_dir), names)


@register(
    "WITH "
    + FACT_SQL
    + ", "
    + PERFORMANCE_SQL
    + """, f AS (SELECT as_of_date, count(*) AS n FROM fact GROUP BY 1),
m AS (SELECT as_of_date, CAST(sum(quote_count) AS BIGINT) AS n FROM performance WHERE cabin_class = 'Economy' GROUP BY 1)
SELECT as_of_date, f.n AS fact_row_count, m.n AS mart_quote_count
FROM f FULL JOIN m USING (as_of_date) WHERE coalesce(f.n, -1) <> coalesce(m.n, -1)"""
)
def recon_mart_against_fact(spark, sf_dir):
    """A mart that lost a cabin does not add up to the fact."""
    rows = stored(fact(spark, sf_dir), "fact")
    mart = marts.route_performance(star.fare_cube(rows)).where(F.col("cabin_class") == "Economy")
    return reconcile.totals_differ(rows, mart, "as_of_date")


@register(
    "WITH "
    + STAGED_SQL
    + """, manifest AS (SELECT as_of_date, count(*) AS source_row_count FROM quotes GROUP BY 1),
landed AS (SELECT as_of_date, count(*) AS n FROM stg GROUP BY 1)
SELECT as_of_date, source_row_count, coalesce(n, 0) AS fact_row_count, source_row_count - coalesce(n, 0) AS variance
FROM manifest LEFT JOIN landed USING (as_of_date) WHERE source_row_count <> coalesce(n, 0)"""
)
def recon_manifest_against_fact(spark, sf_dir):
    raw = quotes(spark, sf_dir, ("as_of_date",))
    manifest = raw.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("source_row_count"))
    return reconcile.manifest_variance(manifest, staged(spark, sf_dir), "as_of_date")


@register(
    """SELECT max(ts) AS newest,
  CAST(floor(epoch(TIMESTAMP '2024-02-01 06:00:00' - max(ts)) / 3600) AS BIGINT) AS age_hours,
  CASE WHEN epoch(TIMESTAMP '2024-02-01 06:00:00' - max(ts)) / 3600 > 48 THEN 'error'
       WHEN epoch(TIMESTAMP '2024-02-01 06:00:00' - max(ts)) / 3600 > 26 THEN 'warn' ELSE 'pass' END AS status
  FROM events"""
)
def freshness_status(spark, sf_dir):
    return checks.freshness(table(spark, sf_dir, "events"), "ts", "2024-02-01 06:00:00")


def _standing_tests(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return {
        "not_null_shipdate": checks.not_null(lines, "l_shipdate"),
        "unique_order": checks.unique(orders, "o_orderkey"),
        "unique_order_line": checks.unique_combination(lines, ("l_orderkey", "l_linenumber")),
        "known_status": checks.accepted_values(lines, "l_linestatus", ("F", "O")),
        "quantity_in_range": checks.accepted_range(lines, "l_quantity", 2, 49),
        "orders_exist": checks.relationships(lines, "l_orderkey", orders, "o_orderkey"),
    }


_TESTS_SQL = """SELECT 'not_null_shipdate' AS test_name, count(*) AS failures FROM lineitem WHERE l_shipdate IS NULL
UNION ALL SELECT 'unique_order', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'unique_order_line', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'known_status', count(DISTINCT l_linestatus) FROM lineitem WHERE l_linestatus NOT IN ('F', 'O')
UNION ALL SELECT 'quantity_in_range', count(*) FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49
UNION ALL SELECT 'orders_exist', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""


@register(_TESTS_SQL)
def table_test_counts(spark, sf_dir):
    """Offending rows per test; a test that passes has zero."""
    return checks.failure_counts(_standing_tests(spark, sf_dir))


@register(f"SELECT * FROM ({_TESTS_SQL}) WHERE failures > 0")
def stored_failures(spark, sf_dir):
    """Offending rows written to a table, counted from there."""
    path = work_area(spark, "failures")
    checks.store_failures(_standing_tests(spark, sf_dir), path)
    return (
        spark.read.parquet(path)
        .groupBy("test_name")
        .agg(F.count(F.lit(1)).alias("failures"))
        .where(F.col("failures") > 0)
    )


@register(
    "WITH "
    + FACT_SQL
    + """, by_route AS (SELECT route_id, count(DISTINCT airline_name) AS n FROM fact GROUP BY 1)
SELECT 'unique_key' AS test_name, count(*) - count(DISTINCT flight_quote_sk) AS failures FROM fact
UNION ALL SELECT 'price_is_positive', count(*) FILTER (price_inr IS NULL OR price_inr <= 0) FROM fact
UNION ALL SELECT 'no_self_routes', count(*) FILTER (origin_city = destination_city) FROM routes
UNION ALL SELECT 'competition_in_range', count(*) FILTER (n < 1 OR n > 5) FROM by_route"""
)
def gold_invariants(spark, sf_dir):
    """The invariants that hold over the gold layer, and one that does not."""
    quote = stored(fact(spark, sf_dir), "fact")
    routes = star.dim_route(star.fare_cube(quote), star.route_lookup(quote))
    return checks.failure_counts(
        {
            "unique_key": checks.unique(quote, "flight_quote_sk"),
            "price_is_positive": checks.not_positive(quote, "price_inr"),
            "no_self_routes": checks.equal_columns(routes, "origin_city", "destination_city"),
            "competition_in_range": checks.accepted_range(
                routes, "competing_airline_count", 1, 5
            ),
        }
    )
