"""Star schema over staged quotes: staging, routes, enriched quotes, fact, dimensions.

Everything up to and including the fact is a projection: the route key is
computed in place instead of being looked up, so no row moves between tasks.
The dimensions and marts read a rollup (``fare_cube``) whose size follows the
number of flights and routes, not the number of quotes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, ShortType, StringType, StructField, StructType

from snapstrata.contract import LeadTimeBands
from snapstrata.functions import expr as X

PREMIUM_CABIN, STANDARD_CABIN = "Business", "Economy"
ROUTE_NAME = ("origin_city", "destination_city", "route_name")


def stage(df: DataFrame, mapping: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """One-to-one rename and cast."""
    return df.select(*X.casts(mapping))


def route_lookup(staged: DataFrame) -> DataFrame:
    """One row per directional route, with the direction-free pair label."""
    routes = staged.select(*ROUTE_NAME).distinct()
    return routes.select(
        X.strict_key("origin_city", "destination_city").alias("route_id"),
        *ROUTE_NAME,
        X.unordered_pair("origin_city", "destination_city").alias("route_pair_name"),
    )


# ---- fixed values: column names and order of the enriched quotes and the fact ----
ENRICHED = (
    "flight_quote_sk",
    "quote_group_sk",
    "as_of_date",
    "route_id",
    "route_name",
    "route_pair_name",
    "origin_city",
    "destination_city",
    "airline_name",
    "flight_number",
    "departure_time_bucket",
    "arrival_time_bucket",
    "stops_label",
    "stops_count",
    "is_nonstop",
    "cabin_class",
    "duration_hours",
    "duration_minutes",
    "days_to_departure",
    "price_inr",
    "lead_time_bucket",
    "lead_time_bucket_sort",
    "price_per_hour_inr",
    "is_premium_cabin",
    "source_file_name",
    "ingested_at",
    "batch_id",
)
FACT = (
    "flight_quote_sk",
    "quote_group_sk",
    "as_of_date",
    "route_id",
    "airline_id",
    "flight_number",
    "airline_name",
    "route_name",
    "origin_city",
    "destination_city",
    "departure_time_bucket",
    "arrival_time_bucket",
    "stops_label",
    "stops_count",
    "is_nonstop",
    "cabin_class",
    "is_premium_cabin",
    "lead_time_bucket",
    "lead_time_bucket_sort",
    "days_to_departure",
    "price_inr",
    "price_per_hour_inr",
    "duration_hours",
    "duration_minutes",
    "source_file_name",
    "ingested_at",
    "batch_id",
)
# ---- end of fixed values ----


def enrich(staged: DataFrame, bands: LeadTimeBands) -> DataFrame:
    """Quote-level measures.  Rows without both cities have no route and drop out."""
    days = F.col("days_to_departure")
    measures = {
        "route_id": X.strict_key("origin_city", "destination_city"),
        "route_pair_name": X.unordered_pair("origin_city", "destination_city"),
        "lead_time_bucket": X.lead_time_label(days, bands),
        "lead_time_bucket_sort": X.lead_time_rank(days, bands),
        "price_per_hour_inr": X.safe_divide("price_inr", "duration_hours"),
        "is_premium_cabin": F.col("cabin_class") == PREMIUM_CABIN,
    }
    return staged.withColumns(measures).where(F.col("route_id").isNotNull()).select(*ENRICHED)


def fact_quotes(enriched: DataFrame) -> DataFrame:
    """One row per quote, with the keys of both dimensions."""
    return enriched.withColumn("airline_id", F.md5("airline_name")).select(*FACT)


CUBE_KEY = (
    "as_of_date",
    "route_id",
    "route_name",
    "origin_city",
    "destination_city",
    "cabin_class",
    "airline_name",
    "flight_number",
)


def fare_cube(quotes: DataFrame, key: Sequence[str] = CUBE_KEY) -> DataFrame:
    """Additive measures per snapshot x route x cabin x carrier x flight.

    All totals are exact decimals, so they add up to the same value whatever
    the partitioning.  Marts and dimensions fold this instead of the fact.
    """
    price = F.col("price_inr")
    per_hour = F.col("price_per_hour_inr")
    return quotes.groupBy(*key).agg(
        F.count(F.lit(1)).alias("quotes"),
        F.count(price).alias("priced"),
        F.sum(price).alias("price_sum"),
        F.sum((price * price).cast("decimal(26,4)")).alias("price_squares"),
        F.min(price).alias("price_min"),
        F.max(price).alias("price_max"),
        F.count("duration_hours").alias("timed"),
        F.sum(F.col("duration_hours").cast("decimal(18,6)")).alias("duration_sum"),
        F.min("duration_hours").alias("duration_min"),
        F.count(per_hour).alias("hourly"),
        F.sum(per_hour.cast("decimal(14,2)")).alias("per_hour_sum"),
        F.count_if("is_nonstop").alias("nonstop"),
    )


def dim_carrier(cube: DataFrame) -> DataFrame:
    folded = cube.groupBy("airline_name").agg(
        F.sum("quotes").alias("quote_count"),
        F.count_distinct("route_id").alias("route_count"),
        F.count_distinct("flight_number").alias("flight_number_count"),
        F.bool_or(F.col("cabin_class") == PREMIUM_CABIN).alias("sells_premium"),
        X.mean_of(F.sum("price_sum"), F.sum("priced")).alias("mean_price"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
    )
    return folded.select(
        F.md5("airline_name").alias("airline_id"),
        "airline_name",
        X.display_name("airline_name").alias("airline_display_name"),
        X.default_to("sells_premium", False).alias("offers_business_class"),
        "quote_count",
        "route_count",
        "flight_number_count",
        X.money(F.col("mean_price")).alias("avg_price_inr"),
        X.exact_money(F.col("price_min")).alias("min_price_inr"),
        X.exact_money(F.col("price_max")).alias("max_price_inr"),
    )


def dim_route(cube: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Routes with their competition, from one fold of the rollup.

    Pass ``routes`` (a ``route_lookup``) to list routes without quotes as well.
    """
    measures = [
        F.count_distinct("airline_name").alias("competing_airline_count"),
        (F.sum("nonstop") > 0).alias("has_nonstop_service"),
        F.min("duration_min").alias("fastest_duration_hours"),
        F.sum("quotes").alias("quote_count"),
    ]
    if routes is not None:
        return routes.join(cube.groupBy("route_id").agg(*measures), "route_id", "left")
    pair = X.unordered_pair("origin_city", "destination_city").alias("route_pair_name")
    folded = cube.groupBy("route_id", *ROUTE_NAME).agg(*measures)
    return folded.select(
        "route_id",
        *ROUTE_NAME,
        pair,
        "competing_airline_count",
        "has_nonstop_service",
        "fastest_duration_hours",
        "quote_count",
    )


BAND_SCHEMA = StructType(
    [
        StructField("lead_time_bucket", StringType(), False),
        StructField("lead_time_bucket_sort", ShortType(), False),
        StructField("min_days_to_departure", IntegerType(), False),
        StructField("max_days_to_departure", IntegerType(), True),
    ]
)


def dim_lead_time_band(spark: SparkSession, bands: LeadTimeBands) -> DataFrame:
    """The bands of a contract as a small table; NULL upper bound means open-ended."""
    return spark.createDataFrame(bands.rows(), BAND_SCHEMA)


def band_join(
    spark: SparkSession, df: DataFrame, days: str, bands: LeadTimeBands
) -> DataFrame:
    """Attach the band whose range holds ``days``; rows in no band keep NULLs.

    The range lookup becomes an equality: the ordinal of the band is computed in
    place and joined to the band table, which comes from the contract and has a
    row per band, so that it may always be broadcast.
    """
    value = F.col(days)
    ordinal = F.when(value >= bands.start, X.lead_time_rank(value, bands)).cast("smallint")
    keyed = df.withColumn("lead_time_bucket_sort", ordinal)
    table = F.broadcast(dim_lead_time_band(spark, bands))
    return keyed.join(table, "lead_time_bucket_sort", "left")
