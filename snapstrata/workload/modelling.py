"""Registered queries: staging, star schema, marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstrata.contracts.flights import STAGED_QUOTE, STAGED_REJECT
from snapstrata.functions import expr as X
from snapstrata.plans import marts, star
from snapstrata.plans import refine as R
from snapstrata.workload.base import (
    BAND_LABEL_SQL,
    BANDS,
    FACT_SQL,
    QUOTES,
    QUOTES_SQL,
    STAGED_SQL,
    TICKET_KEY_SQL,
    TICKETS,
    divide_sql,
    money_sql,
    quotes,
    refined,
    refined_sql,
    register,
    stored,
    valid,
)


def staged(spark, sf_dir):
    return star.stage(valid(spark, sf_dir), STAGED_QUOTE)


def fact(spark, sf_dir):
    return star.fact_quotes(star.enrich(staged(spark, sf_dir), BANDS))


@register("WITH " + STAGED_SQL + " SELECT * FROM stg")
def staged_quotes(spark, sf_dir):
    return staged(spark, sf_dir)


@register(
    "WITH "
    + refined_sql()
    + """ SELECT flight_quote_sk, as_of_date, airline AS airline_name, flight AS flight_number,
  source_city AS origin_city, destination_city, class AS cabin_class, days_left AS days_to_departure,
  price_inr, duration AS duration_hours, rejection_reason, _source_file AS source_file_name,
  _ingested_at AS ingested_at, _batch_id AS batch_id FROM rejected"""
)
def staged_rejects(spark, sf_dir):
    return star.stage(R.rejected_rows(refined(spark, sf_dir), QUOTES), STAGED_REJECT)


@register("WITH " + FACT_SQL + " SELECT * FROM routes")
def route_lookup(spark, sf_dir):
    return star.route_lookup(staged(spark, sf_dir))


@register("WITH " + FACT_SQL + " SELECT * FROM enriched")
def enriched_quotes(spark, sf_dir):
    return star.enrich(staged(spark, sf_dir), BANDS)


@register("WITH " + FACT_SQL + " SELECT * FROM fact")
def fact_quotes(spark, sf_dir):
    return fact(spark, sf_dir)


_CARRIER_SQL = f"""carriers AS (
  SELECT md5(airline_name) AS airline_id, airline_name,
         replace(airline_name, '_', ' ') AS airline_display_name,
         coalesce(bool_or(is_premium_cabin), false) AS offers_business_class,
         count(*) AS quote_count, count(DISTINCT route_id) AS route_count,
         count(DISTINCT flight_number) AS flight_number_count,
         {money_sql("avg(price_inr)")} AS avg_price_inr, {money_sql("min(price_inr)")} AS min_price_inr,
         {money_sql("max(price_inr)")} AS max_price_inr
  FROM fact GROUP BY airline_name)"""
_ROUTE_SQL = """route_dim AS (
  SELECT r.*, c.competing_airline_count, c.has_nonstop_service, c.fastest_duration_hours, c.quote_count
  FROM routes r LEFT JOIN (
    SELECT route_id, count(DISTINCT airline_name) AS competing_airline_count,
           coalesce(bool_or(is_nonstop), false) AS has_nonstop_service,
           min(duration_hours) AS fastest_duration_hours, count(*) AS quote_count
    FROM fact GROUP BY 1) c USING (route_id))"""


@register("WITH " + FACT_SQL + ", " + _CARRIER_SQL + " SELECT * FROM carriers")
def dim_carrier(spark, sf_dir):
    return star.dim_carrier(star.fare_cube(fact(spark, sf_dir)))


@register("WITH " + FACT_SQL + ", " + _ROUTE_SQL + " SELECT * FROM route_dim")
def dim_route(spark, sf_dir):
    return star.dim_route(star.fare_cube(fact(spark, sf_dir)))


_BANDS_SQL = """bands(lead_time_bucket, lead_time_bucket_sort, min_days_to_departure, max_days_to_departure) AS (
  VALUES ('0-30 days (last minute)', 1::SMALLINT, 0, 30), ('31-90 days (short)', 2::SMALLINT, 31, 90),
         ('91-180 days (medium)', 3::SMALLINT, 91, 180), ('181-270 days (long)', 4::SMALLINT, 181, 270),
         ('271+ days (advance)', 5::SMALLINT, 271, NULL))"""


@register(
    "WITH "
    + QUOTES_SQL
    + ", "
    + _BANDS_SQL
    + """ SELECT order_key, line_number, part_key, supp_key, list_price, shipped, days_left, bands.*
  FROM quotes LEFT JOIN bands ON days_left >= min_days_to_departure
   AND (max_days_to_departure IS NULL OR days_left <= max_days_to_departure)"""
)
def band_range_join(spark, sf_dir):
    """Every line with the band its lead time falls into; negative lead times have none."""
    columns = ("order_key", "line_number", "part_key", "supp_key", "list_price", "shipped", "days_left")
    rows = quotes(spark, sf_dir, columns)
    return star.band_join(spark, rows, "days_left", BANDS)


@register(
    "WITH "
    + QUOTES_SQL
    + ", "
    + _BANDS_SQL
    + f""", labelled AS (
  SELECT {BAND_LABEL_SQL.replace('days_to_departure', 'days_left')} AS lead_time_bucket, price FROM quotes)
SELECT bands.*, count(l.lead_time_bucket) AS line_count, sum(l.price) AS price_total
FROM bands LEFT JOIN labelled l USING (lead_time_bucket) GROUP BY ALL"""
)
def dim_lead_time_band(spark, sf_dir):
    """The band dimension with the lines and money that the band labels give to each."""
    rows = quotes(spark, sf_dir, ("days_left", "price"))
    used = rows.groupBy(X.lead_time_label("days_left", BANDS).alias("lead_time_bucket")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("price").cast("decimal(38,2)").alias("price_total")
    )
    bands = star.dim_lead_time_band(spark, BANDS)
    return bands.join(used, "lead_time_bucket", "left").withColumn(
        "line_count", F.coalesce("line_count", F.lit(0))
    )


@register(
    "WITH "
    + FACT_SQL
    + ", "
    + _CARRIER_SQL
    + ", "
    + _ROUTE_SQL
    + """ SELECT f.as_of_date, c.airline_display_name, r.route_pair_name, r.has_nonstop_service,
  count(*) AS quote_count, CAST(sum(f.price_inr) AS DECIMAL(38,2)) AS price_total
  FROM fact f JOIN route_dim r USING (route_id) JOIN carriers c USING (airline_id) GROUP BY ALL"""
)
def star_join(spark, sf_dir):
    """Fact with both dimensions.  Neither is hinted: adaptive execution broadcasts a
    dimension when its measured size allows it and shuffles otherwise."""
    cube = stored(star.fare_cube(fact(spark, sf_dir)), "cube")
    folded = cube.groupBy("as_of_date", "route_id", F.md5("airline_name").alias("airline_id")).agg(
        F.sum("quotes").alias("n"), F.sum("price_sum").alias("total")
    )
    routes = star.dim_route(cube, star.route_lookup(cube))
    carriers = star.dim_carrier(cube)
    joined = folded.join(
        routes.select("route_id", "route_pair_name", "has_nonstop_service"), "route_id"
    ).join(carriers.select("airline_id", "airline_display_name"), "airline_id")
    return joined.groupBy(
        "as_of_date", "airline_display_name", "route_pair_name", "has_nonstop_service"
    ).agg(
        F.sum("n").alias("quote_count"), F.sum("total").cast("decimal(38,2)").alias("price_total")
    )


_PERFORMANCE_SQL = f"""performance AS (
  SELECT as_of_date, route_id, route_name, origin_city, destination_city, cabin_class,
         count(*) AS quote_count, count(DISTINCT airline_name) AS airline_count,
         count(DISTINCT flight_number) AS flight_number_count,
         {money_sql("avg(price_inr)")} AS avg_price_inr, {money_sql("min(price_inr)")} AS min_price_inr,
         {money_sql("max(price_inr)")} AS max_price_inr,
         {money_sql("max(price_inr) - min(price_inr)")} AS price_spread_inr,
         {money_sql("stddev_samp(price_inr)")} AS price_stddev_inr,
         {divide_sql("max(price_inr)", "min(price_inr)")} AS max_to_min_price_ratio,
         {divide_sql("avg(duration_hours)", "1")} AS avg_duration_hours,
         min(duration_hours) AS fastest_duration_hours,
         {money_sql("avg(CAST(price_per_hour_inr AS DECIMAL(14,2)))")} AS avg_price_per_hour_inr,
         {divide_sql("count(*) FILTER (is_nonstop) * 100.0", "count(*)")} AS nonstop_share_pct
  FROM fact GROUP BY 1, 2, 3, 4, 5, 6)"""


@register("WITH " + FACT_SQL + ", " + _PERFORMANCE_SQL + " SELECT * FROM performance")
def mart_route_performance(spark, sf_dir):
    return marts.route_performance(star.fare_cube(fact(spark, sf_dir)))


@register(
    "WITH "
    + FACT_SQL
    + f""", by_band AS (
  SELECT as_of_date, route_id, route_name, cabin_class, lead_time_bucket, lead_time_bucket_sort,
         count(*) AS quote_count, min(days_to_departure) AS min_days_to_departure,
         max(days_to_departure) AS max_days_to_departure,
         {money_sql("avg(price_inr)")} AS avg_price_inr, {money_sql("min(price_inr)")} AS min_price_inr,
         {money_sql("max(price_inr)")} AS max_price_inr,
         {money_sql("avg(CAST(price_per_hour_inr AS DECIMAL(14,2)))")} AS avg_price_per_hour_inr
  FROM fact GROUP BY 1, 2, 3, 4, 5, 6),
based AS (
  SELECT *, min(avg_price_inr) OVER (PARTITION BY as_of_date, route_id, cabin_class) AS cheapest_band_avg_price_inr,
         first_value(avg_price_inr) OVER (PARTITION BY as_of_date, route_id, cabin_class
           ORDER BY lead_time_bucket_sort DESC) AS advance
  FROM by_band)
SELECT * EXCLUDE (advance),
       {divide_sql("avg_price_inr * 100.0", "cheapest_band_avg_price_inr")} AS price_index_vs_cheapest_band,
       {divide_sql("(avg_price_inr - advance) * 100.0", "advance")} AS pct_uplift_vs_advance_band
FROM based"""
)
def mart_lead_time_pricing(spark, sf_dir):
    return marts.lead_time_pricing(fact(spark, sf_dir))


_MIX_SQL = f"""mix AS (
  SELECT *, {divide_sql("quote_count * 100.0", "sum(quote_count) OVER (PARTITION BY as_of_date, route_id)")} AS route_share_pct,
         {divide_sql("(avg_business_price_inr - avg_economy_price_inr) * 100.0", "avg_economy_price_inr")} AS business_premium_pct,
         business_quote_count > 0 AS sells_business_cabin
  FROM (
    SELECT as_of_date, route_id, route_name, airline_name, count(*) AS quote_count,
           count(DISTINCT flight_number) AS flight_number_count,
           count(*) FILTER (cabin_class = 'Economy') AS economy_quote_count,
           count(*) FILTER (cabin_class = 'Business') AS business_quote_count,
           {money_sql("avg(price_inr) FILTER (cabin_class = 'Economy')")} AS avg_economy_price_inr,
           {money_sql("avg(price_inr) FILTER (cabin_class = 'Business')")} AS avg_business_price_inr,
           {money_sql("avg(price_inr)")} AS avg_price_inr,
           {divide_sql("count(*) FILTER (is_nonstop) * 100.0", "count(*)")} AS nonstop_share_pct
    FROM fact GROUP BY 1, 2, 3, 4))"""


@register("WITH " + FACT_SQL + ", " + _MIX_SQL + " SELECT * FROM mix")
def mart_carrier_cabin_mix(spark, sf_dir):
    return marts.carrier_cabin_mix(star.fare_cube(fact(spark, sf_dir)))


QUALITY_TAIL_SQL = f""", reasons AS (
  SELECT as_of_date, rejection_reason, count(*) AS n FROM rejected GROUP BY 1, 2),
totals AS (SELECT as_of_date, CAST(sum(n) AS BIGINT) AS n FROM reasons GROUP BY 1),
passed AS (SELECT as_of_date, count(*) AS n FROM valid GROUP BY 1),
quality AS (
  SELECT as_of_date, coalesce(r.rejection_reason, 'n/a') AS rejection_reason,
         coalesce(r.n, 0) AS rejected_row_count_for_reason, coalesce(p.n, 0) AS accepted_row_count,
         coalesce(t.n, 0) AS rejected_row_count_total,
         coalesce(p.n, 0) + coalesce(t.n, 0) AS bronze_row_count_reconciled,
         {divide_sql("coalesce(t.n, 0) * 100.0", "(coalesce(p.n, 0) + coalesce(t.n, 0))")} AS rejected_pct
  FROM passed p FULL JOIN totals t USING (as_of_date) LEFT JOIN reasons r USING (as_of_date))"""


def _quality_sql(key: str) -> str:
    return refined_sql(key) + QUALITY_TAIL_SQL


def reasons_per_snapshot(spark, sf_dir):
    rows = refined(spark, sf_dir, TICKETS)
    return rows.groupBy("as_of_date", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))


@register("WITH " + _quality_sql(TICKET_KEY_SQL) + " SELECT * FROM quality")
def mart_data_quality_summary(spark, sf_dir):
    return marts.data_quality_summary(reasons_per_snapshot(spark, sf_dir))


# shared with the checks
CARRIER_SQL, ROUTE_SQL, PERFORMANCE_SQL, MIX_SQL = _CARRIER_SQL, _ROUTE_SQL, _PERFORMANCE_SQL, _MIX_SQL
quality_sql = _quality_sql
