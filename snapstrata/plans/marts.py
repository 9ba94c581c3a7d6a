"""Marts: fare distribution per route, lead-time curve, carrier mix, data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.functions import expr as X
from snapstrata.plans.star import PREMIUM_CABIN, STANDARD_CABIN

ROUTE_CABIN = (
    "as_of_date",
    "route_id",
    "route_name",
    "origin_city",
    "destination_city",
    "cabin_class",
)


def sample_stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact power sums; NULL for fewer than two rows.

    Mean and mean square are taken in decimal, so equal values give exactly zero
    instead of the residue that subtracting two large doubles would leave.
    """
    count = n.cast("decimal(13,0)")
    mean = (total.cast("decimal(22,2)") / count).cast("decimal(25,14)")
    spread = (squares.cast("decimal(30,4)") / count) - (mean * mean)
    population = F.greatest(spread.cast("double"), F.lit(0.0))
    return F.when(n > 1, F.sqrt(population * n / (n - F.lit(1))))


def route_performance(cube: DataFrame) -> DataFrame:
    """Fare distribution, competition and product mix per route, cabin and snapshot."""
    low, high = F.min("price_min"), F.max("price_max")
    priced = F.sum("priced")
    return cube.groupBy(*ROUTE_CABIN).agg(
        F.sum("quotes").alias("quote_count"),
        F.count_distinct("airline_name").alias("airline_count"),
        F.count_distinct("flight_number").alias("flight_number_count"),
        X.money(X.mean_of(F.sum("price_sum"), priced)).alias("avg_price_inr"),
        X.exact_money(low).alias("min_price_inr"),
        X.exact_money(high).alias("max_price_inr"),
        X.exact_money(high - low).alias("price_spread_inr"),
        X.money(sample_stddev(priced, F.sum("price_sum"), F.sum("price_squares"))).alias(
            "price_stddev_inr"
        ),
        X.safe_divide(high, low).alias("max_to_min_price_ratio"),
        X.safe_divide(F.sum("duration_sum"), F.sum("timed")).alias("avg_duration_hours"),
        F.min("duration_min").alias("fastest_duration_hours"),
        X.money(X.mean_of(F.sum("per_hour_sum"), F.sum("hourly"))).alias("avg_price_per_hour_inr"),
        X.percent(F.sum("nonstop"), F.sum("quotes")).alias("nonstop_share_pct"),
    )


BAND_KEY = (
    "as_of_date",
    "route_id",
    "route_name",
    "cabin_class",
    "lead_time_bucket",
    "lead_time_bucket_sort",
)


def lead_time_pricing(quotes: DataFrame) -> DataFrame:
    """Fare per lead-time band against the cheapest and the furthest-out band.

    The windows run over one row per band, so a group never exceeds the number
    of bands in the contract.
    """
    price = F.col("price_inr")
    per_hour = F.col("price_per_hour_inr").cast("decimal(14,2)")
    by_band = quotes.groupBy(*BAND_KEY).agg(
        F.count(F.lit(1)).alias("quote_count"),
        F.min("days_to_departure").alias("min_days_to_departure"),
        F.max("days_to_departure").alias("max_days_to_departure"),
        X.money(X.mean_of(F.sum(price), F.count(price))).alias("avg_price_inr"),
        X.exact_money(F.min(price)).alias("min_price_inr"),
        X.exact_money(F.max(price)).alias("max_price_inr"),
        X.money(X.mean_of(F.sum(per_hour), F.count(per_hour))).alias("avg_price_per_hour_inr"),
    )
    curve = Window.partitionBy("as_of_date", "route_id", "cabin_class")
    furthest_first = curve.orderBy(F.desc("lead_time_bucket_sort"))
    fare = F.col("avg_price_inr")
    with_baselines = by_band.withColumns(
        {
            "cheapest_band_avg_price_inr": F.min(fare).over(curve),
            "_advance": F.first(fare).over(furthest_first),
        }
    )
    uplift = (fare - F.col("_advance")).cast("double") * F.lit(100.0)
    return with_baselines.select(
        *by_band.columns,
        "cheapest_band_avg_price_inr",
        X.percent(fare, "cheapest_band_avg_price_inr").alias("price_index_vs_cheapest_band"),
        X.safe_divide(uplift, "_advance").alias("pct_uplift_vs_advance_band"),
    )


def carrier_cabin_mix(cube: DataFrame) -> DataFrame:
    """Each carrier's share of a route and its premium-cabin mark-up."""

    def in_cabin(cabin: str, measure: str) -> Column:
        return F.sum(F.when(F.col("cabin_class") == cabin, F.col(measure)))

    def cabin_mean(cabin: str) -> Column:
        mean = X.mean_of(in_cabin(cabin, "price_sum"), in_cabin(cabin, "priced"))
        return X.money(mean)

    by_carrier = cube.groupBy("as_of_date", "route_id", "route_name", "airline_name").agg(
        F.sum("quotes").alias("quote_count"),
        F.count_distinct("flight_number").alias("flight_number_count"),
        X.default_to(in_cabin(STANDARD_CABIN, "quotes"), 0).alias("economy_quote_count"),
        X.default_to(in_cabin(PREMIUM_CABIN, "quotes"), 0).alias("business_quote_count"),
        cabin_mean(STANDARD_CABIN).alias("avg_economy_price_inr"),
        cabin_mean(PREMIUM_CABIN).alias("avg_business_price_inr"),
        X.money(X.mean_of(F.sum("price_sum"), F.sum("priced"))).alias("avg_price_inr"),
        X.percent(F.sum("nonstop"), F.sum("quotes")).alias("nonstop_share_pct"),
    )
    on_route = F.sum("quote_count").over(Window.partitionBy("as_of_date", "route_id"))
    markup = (F.col("avg_business_price_inr") - F.col("avg_economy_price_inr")).cast("double")
    return by_carrier.select(
        "*",
        X.percent("quote_count", on_route).alias("route_share_pct"),
        X.safe_divide(markup * F.lit(100.0), "avg_economy_price_inr").alias("business_premium_pct"),
        (F.col("business_quote_count") > 0).alias("sells_business_cabin"),
    )


def reason_table(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows per snapshot and reason from the two halves; accepted rows have no reason."""
    n = F.count(F.lit(1)).alias("n")
    passed = accepted.groupBy("as_of_date").agg(n)
    reasons = rejected.groupBy("as_of_date", "rejection_reason").agg(n)
    return reasons.unionByName(passed, allowMissingColumns=True)


def data_quality_summary(counts: DataFrame, *, keep_rejected_only: bool = True) -> DataFrame:
    """Rejected rows per snapshot and reason, beside the accepted count.

    Takes rows per (``as_of_date``, ``rejection_reason``) with ``n``, where
    accepted rows have no reason; the window sees one row per reason.  A
    snapshot without rejects shows one row with reason ``n/a``; one whose rows
    were all rejected stays unless ``keep_rejected_only`` is turned off.
    """
    day = Window.partitionBy("as_of_date")
    reason = F.col("rejection_reason")
    let_in = X.default_to(F.sum(F.when(reason.isNull(), F.col("n"))).over(day), 0)
    turned_away = X.default_to(F.sum(F.when(reason.isNotNull(), F.col("n"))).over(day), 0)
    rows = counts.withColumns({"let_in": let_in, "turned_away": turned_away})
    shown = rows.where(reason.isNotNull() | (F.col("turned_away") == 0))
    if not keep_rejected_only:
        shown = shown.where(F.col("let_in") > 0)
    both = F.col("let_in") + F.col("turned_away")
    return shown.select(
        "as_of_date",
        X.default_to("rejection_reason", "n/a").alias("rejection_reason"),
        F.when(reason.isNotNull(), F.col("n")).otherwise(0).alias("rejected_row_count_for_reason"),
        F.col("let_in").alias("accepted_row_count"),
        F.col("turned_away").alias("rejected_row_count_total"),
        both.alias("bronze_row_count_reconciled"),
        X.percent("turned_away", both).alias("rejected_pct"),
    )
