"""Dimensions from stored parts per snapshot, with exact distinct counts that merge.

A refresh adds up a row per snapshot and member instead of folding the whole rollup again.
What can't be added up, the number of distinct routes, flights or carriers, is kept as bitmaps over
numbered values: a bit per value, in buckets of a fixed size, so two snapshots merge by OR and
the count stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from snapstrata.functions import expr as X
from snapstrata.operators.merge import partition_values
from snapstrata.plans.star import PREMIUM_CABIN, ROUTE_NAME
from snapstrata.sources import tables

NUMBERS = StructType([StructField("kind", StringType()), StructField("value", StringType()), StructField("number", LongType())])
COUNTED = ("route_id", "flight_number", "airline_name")


def number_values(spark: SparkSession, path: str, rows: DataFrame, columns: Sequence[str] = COUNTED) -> DataFrame:
    """Enter the values of the columns that the dictionary does not know; returns the whole dictionary.

    A number is given once and stays.  Numbers rise, but need not be dense: a task numbers its own
    values.  Values that a failed run has entered are simply known to the next.  Use what is returned
    before more values are entered: Spark takes readings of one path in one plan for the same table.
    """
    known = tables.read_or_empty(spark, path, NUMBERS)
    last = known.agg(F.max("number")).first()[0]
    told = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns]))
    found = rows.select(told.alias("v")).select("v.*").where(F.col("value").isNotNull()).distinct()
    fresh = found.join(known.select("kind", "value"), ["kind", "value"], "left_anti")
    first = F.lit(0 if last is None else last + 1)
    tables.append_rows(fresh.withColumn("number", (F.monotonically_increasing_id() + first).cast("long")), path)
    return spark.read.schema(NUMBERS).parquet(path)


def member_bitmaps(rows: DataFrame, by: Sequence[str], counted: str, numbers: DataFrame) -> DataFrame:
    """(*by, kind, bucket, bits): which values of ``counted`` each group holds; NULL is no value."""
    own = numbers.where(F.col("kind") == counted).select(F.col("value").alias("_value"), "number")
    pairs = rows.select(*by, F.col(counted).cast("string").alias("_value")).where(F.col("_value").isNotNull()).distinct()
    bucket = F.bitmap_bucket_number("number")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number"))
    grouped = pairs.join(own, "_value").groupBy(*by, bucket.alias("bucket")).agg(bits.alias("bits"))
    return grouped.select(*by, F.lit(counted).alias("kind"), "bucket", "bits")


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], **names: str) -> DataFrame:
    """(*by, a count for each name): ``names`` maps columns of the result to what was counted."""
    merged = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0).cast("long"))

    return merged.groupBy(*by).agg(*[total(kind).alias(name) for name, kind in names.items()])


ROUTE_KEY = ("route_id", *ROUTE_NAME)
CARRIER_KEY = ("airline_name",)


def store_parts(spark: SparkSession, root: str, cube: DataFrame, snapshot: str = "as_of_date") -> None:
    """Replace the stored parts of the snapshots in ``cube``; no other snapshot is read."""
    days = [(d,) for d in partition_values(cube, snapshot)]
    numbers = number_values(spark, f"{root}/numbers", cube)

    def replace(frame: DataFrame, name: str) -> None:
        tables.write_partitions(frame, f"{root}/{name}", by=(snapshot,), owned=days)

    sums = [
        F.sum("quotes").alias("quotes"),
        F.sum("priced").alias("priced"),
        F.sum("price_sum").alias("price_sum"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
        F.sum("nonstop").alias("nonstop"),
        F.min("duration_min").alias("duration_min"),
        F.bool_or(F.col("cabin_class") == PREMIUM_CABIN).alias("premium"),
    ]
    for name, key, kinds in (("carriers", CARRIER_KEY, ("route_id", "flight_number")), ("routes", ROUTE_KEY, ("airline_name",))):
        by = (snapshot, *key)
        replace(cube.groupBy(*by).agg(*sums), f"{name}_sums")
        bits = member_bitmaps(cube, by, kinds[0], numbers)
        for kind in kinds[1:]:
            bits = bits.unionAll(member_bitmaps(cube, by, kind, numbers))
        replace(bits, f"{name}_bits")


def dim_carrier(spark: SparkSession, root: str) -> DataFrame:
    """As ``star.dim_carrier``, from stored parts."""
    sums, bits = (spark.read.parquet(f"{root}/carriers_{part}") for part in ("sums", "bits"))
    folded = sums.groupBy(*CARRIER_KEY).agg(
        F.sum("quotes").alias("quote_count"),
        F.bool_or("premium").alias("sells_premium"),
        X.mean_of(F.sum("price_sum"), F.sum("priced")).alias("mean_price"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
    )
    counts = distinct_counts(bits, CARRIER_KEY, route_count="route_id", flight_number_count="flight_number")
    return folded.join(counts, list(CARRIER_KEY), "left").select(
        F.md5("airline_name").alias("airline_id"),
        "airline_name",
        X.display_name("airline_name").alias("airline_display_name"),
        X.default_to("sells_premium", False).alias("offers_business_class"),
        "quote_count",
        X.default_to("route_count", 0).alias("route_count"),
        X.default_to("flight_number_count", 0).alias("flight_number_count"),
        X.money(F.col("mean_price")).alias("avg_price_inr"),
        X.exact_money(F.col("price_min")).alias("min_price_inr"),
        X.exact_money(F.col("price_max")).alias("max_price_inr"),
    )


def dim_route(spark: SparkSession, root: str) -> DataFrame:
    """As ``star.dim_route``, from stored parts."""
    sums, bits = (spark.read.parquet(f"{root}/routes_{part}") for part in ("sums", "bits"))
    folded = sums.groupBy(*ROUTE_KEY).agg(
        (F.sum("nonstop") > 0).alias("has_nonstop_service"),
        F.min("duration_min").alias("fastest_duration_hours"),
        F.sum("quotes").alias("quote_count"),
    )
    counts = distinct_counts(bits, ("route_id",), competing_airline_count="airline_name")
    return folded.join(counts, "route_id", "left").select(
        *ROUTE_KEY,
        X.unordered_pair("origin_city", "destination_city").alias("route_pair_name"),
        X.default_to("competing_airline_count", 0).alias("competing_airline_count"),
        "has_nonstop_service",
        "fastest_duration_hours",
        "quote_count",
    )
