"""The fare-quote view over the driver's tables, its contracts, and the registry.

The tables hold no fare file, so order lines stand in for quotes: part type is
the carrier, brand the flight, supplier and customer regions the two cities,
and so on.  Some values are blanked, padded or re-cased on purpose so that the
cleaning and the rules have something to do.  The SQL beside each query states
the same thing independently.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstrata.contract import LeadTimeBands
from snapstrata.contracts.flights import CABINS, FLIGHTS, fare_rules
from snapstrata.operators.lookup import look_up
from snapstrata.plans.refine import accepted_rows, refine
from snapstrata.session import freed_shuffles, work_area, writer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; its schema is looked up in the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# ---- fixed values: what the stand-in data may hold ----
CARRIERS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
BANDS = LeadTimeBands(
    steps=(("last minute", 30), ("short", 90), ("medium", 180), ("long", 270)),
    open_ended="advance",
)
# ---- end of fixed values ----

TIEBREAK = (
    ("_ingested_at", "desc"),
    ("order_key", "asc"),
    ("line_number", "asc"),
    ("part_key", "asc"),
    ("supp_key", "asc"),
    ("list_price", "asc"),
)
QUOTES = FLIGHTS.with_options(
    name="quotes",
    rules=fare_rules(
        airlines=CARRIERS,
        cities=REGIONS,
        departure_times=PRIORITIES,
        arrival_times=SEGMENTS,
        price=(1, 100_000),
        duration=(2, 50),
        days_left=(0, 365),
        nonstop_max=45,
    ),
    bands=BANDS,
    tiebreak=TIEBREAK,
)
#: the same rows under a key that really repeats: about a quarter of them lose
TICKETS = QUOTES.with_options(name="tickets", business_key=("order_key", "line_number"))

LINE_ID = ("order_key", "line_number", "part_key", "supp_key", "list_price", "shipped")

_FROM_ORDERS = {"days_left", "as_of_date", "departure_time", "_batch_id", "destination_city", "arrival_time"}
_FROM_CUSTOMER = {"destination_city", "arrival_time"}
_FROM_SUPPLIER = {"source_city"}
_FROM_PART = {"airline", "flight"}


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", "r_name"
    )


def quotes(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Order lines as raw quotes.

    All lookups are left joins on unique keys: a line with a dangling reference
    stays, with NULLs for the rules to report.  That also means a lookup nobody
    asks for can be left out, so only the tables behind ``columns`` are joined.
    """
    lines = table(spark, sf_dir, "lineitem")
    wanted = None if columns is None else set(columns)

    def needed(names: set[str]) -> bool:
        return wanted is None or bool(names & wanted)

    # what a quote takes from its line alone, before any lookup: the joins carry nothing else of it
    shipped = F.col("l_shipdate")
    out = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity")).alias("_duration"),
        (~((F.col("l_tax") == 0) & (F.col("l_discount") == 0))).alias("_priced"),
        (~((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0))).alias("_dated"),
    )
    made = {
        "order_key": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber"),
        "part_key": F.col("l_partkey"),
        "supp_key": F.col("l_suppkey"),
        "list_price": F.col("l_extendedprice"),
        "shipped": shipped.cast("date"),
        "stops": F.when(F.col("l_returnflag") == "N", "ZERO")
        .when(F.col("l_returnflag") == "R", " One")
        .otherwise("two_or_more "),
        "class": F.when(F.col("l_linestatus") == "F", " BUSINESS ").otherwise("economy"),
        "duration": F.col("_duration"),
        "price": F.when(F.col("_priced"), F.col("l_extendedprice").cast("decimal(12,2)")),
        "_source_file": F.lit("lineitem"),
        "_source_row": F.col("l_linenumber"),
        "_ingested_at": shipped.cast("timestamp"),
    }
    if needed(_FROM_PART):
        made |= {"airline": F.col("p_airline"), "flight": F.col("p_flight")}
    if needed(_FROM_SUPPLIER):
        made["source_city"] = F.when(F.col("s_acctbal") >= 0, F.col("s_region"))
    # orders first: they are the largest lookup, and lines are at their narrowest for its shuffle
    if needed(_FROM_ORDERS):
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("ordered")
        )
        if needed(_FROM_CUSTOMER):
            # as with the supplier below, the lookup goes by the size of the customer file alone
            buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
            city = _regions(spark, sf_dir).withColumnRenamed("r_name", "c_city")
            orders = look_up(orders, "o_custkey", buyer, "c_custkey")
            orders = orders.join(city, F.col("c_nationkey") == F.col("n_nationkey"), "left").drop("n_nationkey")
            made["destination_city"] = F.col("c_city")
            made["arrival_time"] = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        days = F.datediff(shipped.cast("date"), F.col("ordered"))
        made["days_left"] = F.when(F.col("_dated"), days)
        made["departure_time"] = F.col("o_orderpriority")
        made["as_of_date"] = F.trunc("ordered", "year")
        made["_batch_id"] = F.concat(F.lit("batch-"), F.year("ordered").cast("string"))
    if needed(_FROM_PART):
        part = table(spark, sf_dir, "part").select(
            "p_partkey",
            F.when(F.col("p_size") == 50, "").otherwise(F.col("p_type")).alias("p_airline"),
            F.concat(F.lit(" "), F.lower(F.nullif(F.col("p_brand"), F.lit("Brand#25")))).alias("p_flight"),
        )
        out = look_up(out, "l_partkey", part, "p_partkey")
    if needed(_FROM_SUPPLIER):
        # the region lookup hangs off the joined supplier, so that Spark plans the
        # supplier join by the size of the supplier file alone
        home = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
        city = _regions(spark, sf_dir).withColumnRenamed("r_name", "s_region")
        out = out.join(home, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        out = out.join(city, F.col("s_nationkey") == F.col("n_nationkey"), "left").drop("n_nationkey")
    names = made if wanted is None else [n for n in made if n in wanted]
    return out.select(*[made[n].alias(n) for n in names])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that several branches read, as the layers in production are."""
    path = work_area(df.sparkSession, purpose)
    with freed_shuffles(df.sparkSession):
        writer(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refined(spark: SparkSession, sf_dir: str, contract=QUOTES) -> DataFrame:
    # the search for duplicates reads its input twice: land the quotes first, as the
    # raw layer does, instead of repeating the lookups
    return refine(stored(quotes(spark, sf_dir), "raw"), contract)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_rows(quotes(spark, sf_dir), QUOTES)


# --- the same view in SQL ---------------------------------------------------

QUOTES_SQL = """quotes AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
         l_suppkey AS supp_key, l_extendedprice AS list_price,
         CAST(l_shipdate AS DATE) AS shipped,
         CASE WHEN p_size = 50 THEN '' ELSE p_type END AS airline,
         upper(nullif(p_brand, 'Brand#25')) AS flight,
         CASE WHEN s_acctbal >= 0 THEN sr.r_name END AS source_city,
         cr.r_name AS destination_city,
         o_orderpriority AS departure_time,
         nullif(c_mktsegment, 'MACHINERY') AS arrival_time,
         CASE l_returnflag WHEN 'N' THEN 'zero' WHEN 'R' THEN 'one' ELSE 'two_or_more' END AS stops,
         CASE l_linestatus WHEN 'F' THEN 'Business' ELSE 'Economy' END AS class,
         CASE WHEN l_tax <> 0.08 THEN l_quantity END AS duration,
         CASE WHEN NOT (l_linenumber = 7 AND l_tax = 0)
              THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
         END AS days_left,
         CASE WHEN NOT (l_tax = 0 AND l_discount = 0)
              THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS price,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date,
         'lineitem' AS _source_file, l_linenumber AS _source_row,
         CAST(l_shipdate AS TIMESTAMP) AS _ingested_at,
         'batch-' || CAST(year(o_orderdate) AS VARCHAR) AS _batch_id
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
  LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey)"""

STD_SQL = (
    QUOTES_SQL
    + """, std AS (
  SELECT *, CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 WHEN 'two_or_more' THEN 2 END AS stops_count,
         stops = 'zero' AS is_nonstop,
         concat_ws('-', source_city, destination_city) AS route,
         CAST(round(duration * 60) AS INTEGER) AS duration_minutes,
         CAST(price AS DECIMAL(12,2)) AS price_inr,
         md5(concat_ws('||', {key})) AS flight_quote_sk,
         md5(concat_ws('||', flight, source_city, destination_city, departure_time, arrival_time,
                       class, days_left, as_of_date)) AS quote_group_sk
  FROM quotes)"""
)

QUOTE_KEY_SQL = (
    "flight, source_city, destination_city, departure_time, arrival_time, class, "
    "days_left, duration, price, as_of_date"
)
TICKET_KEY_SQL = "order_key, line_number"


def in_list(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


REASON_CASES = [
    ("null_flight", "flight IS NULL OR flight = ''"),
    ("null_airline", "airline IS NULL OR airline = ''"),
    ("null_price", "price IS NULL"),
    ("null_duration", "duration IS NULL"),
    ("null_days_left", "days_left IS NULL"),
    ("null_route_city", "source_city IS NULL OR destination_city IS NULL"),
    ("price_out_of_range", "price < 1 OR price > 100000"),
    ("duration_out_of_range", "duration < 2 OR duration > 50"),
    ("days_left_out_of_range", "days_left < 0 OR days_left > 365"),
    ("same_source_and_destination", "source_city = destination_city"),
    ("implausible_nonstop_duration", "stops = 'zero' AND duration > 45"),
    ("invalid_airline", f"airline NOT IN ({in_list(CARRIERS)})"),
    ("invalid_source_city", f"source_city NOT IN ({in_list(REGIONS)})"),
    ("invalid_destination_city", f"destination_city NOT IN ({in_list(REGIONS)})"),
    ("invalid_departure_time", f"departure_time NOT IN ({in_list(PRIORITIES)})"),
    ("invalid_arrival_time", f"arrival_time NOT IN ({in_list(SEGMENTS)})"),
    ("invalid_stops", "stops NOT IN ('zero', 'one', 'two_or_more')"),
    ("invalid_class", f"class NOT IN ({in_list(CABINS)})"),
]
GAP_CASES = [(f"null_{c}", f"{c} IS NULL") for c in ("departure_time", "arrival_time", "stops", "class")]
ORDER_SQL = "_ingested_at DESC, order_key, line_number, part_key, supp_key, list_price"


def reasons_sql(cases: list[tuple[str, str]]) -> str:
    """All failed reasons as a comma-separated text, empty on a valid row."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in cases) + ")"


def judged_sql(key: str = QUOTE_KEY_SQL, cases: list[tuple[str, str]] = REASON_CASES) -> str:
    """CTEs up to ``judged``: own reasons as text."""
    return STD_SQL.format(key=key) + f", judged AS (SELECT *, {reasons_sql(cases)} AS own FROM std)"


def refined_sql(key: str = QUOTE_KEY_SQL, cases: list[tuple[str, str]] = REASON_CASES) -> str:
    """CTEs up to ``refined``: outcome and reason per row, ``valid`` and ``rejected``."""
    return (
        judged_sql(key, cases)
        + f""", ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ORDER_SQL}) AS place FROM judged),
refined AS (
  SELECT * EXCLUDE (own, place),
         CASE WHEN place = 1 AND own = '' THEN 'valid' ELSE 'rejected' END AS outcome,
         CASE WHEN place > 1 THEN 'duplicate_business_key' ELSE nullif(own, '') END AS rejection_reason
  FROM ranked),
valid AS (SELECT * FROM refined WHERE outcome = 'valid'),
rejected AS (SELECT * FROM refined WHERE outcome = 'rejected')"""
    )


QUOTE_COLUMNS_SQL = (
    "flight_quote_sk, quote_group_sk, as_of_date, airline, flight, source_city, destination_city, "
    "route, departure_time, arrival_time, stops, stops_count, is_nonstop, class, duration, "
    "duration_minutes, days_left, price_inr, _source_file, _source_row, _ingested_at, _batch_id"
)

BAND_LABEL_SQL = """CASE WHEN days_to_departure <= 30 THEN '0-30 days (last minute)'
              WHEN days_to_departure <= 90 THEN '31-90 days (short)'
              WHEN days_to_departure <= 180 THEN '91-180 days (medium)'
              WHEN days_to_departure <= 270 THEN '181-270 days (long)'
              ELSE '271+ days (advance)' END"""
BAND_RANK_SQL = """CASE WHEN days_to_departure <= 30 THEN 1 WHEN days_to_departure <= 90 THEN 2
              WHEN days_to_departure <= 180 THEN 3 WHEN days_to_departure <= 270 THEN 4 ELSE 5 END"""


def divide_sql(n: str, d: str, places: int = 2) -> str:
    return (
        f"round(CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL "
        f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END, {places})"
    )


def money_sql(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(14,2))"


STAGED_SQL = (
    refined_sql()
    + """, stg AS (
  SELECT flight_quote_sk, quote_group_sk, as_of_date, airline AS airline_name, flight AS flight_number,
         source_city AS origin_city, destination_city, route AS route_name,
         departure_time AS departure_time_bucket, arrival_time AS arrival_time_bucket,
         stops AS stops_label, stops_count, is_nonstop, class AS cabin_class,
         duration AS duration_hours, duration_minutes, days_left AS days_to_departure, price_inr,
         _source_file AS source_file_name, _source_row AS source_row_number,
         _ingested_at AS ingested_at, _batch_id AS batch_id
  FROM valid)"""
)
FACT_SQL = (
    STAGED_SQL
    + f""", routes AS (
  SELECT md5(origin_city || '||' || destination_city) AS route_id, origin_city, destination_city, route_name,
         CASE WHEN origin_city < destination_city THEN origin_city || '<->' || destination_city
              ELSE destination_city || '<->' || origin_city END AS route_pair_name
  FROM (SELECT DISTINCT origin_city, destination_city, route_name FROM stg)),
enriched AS (
  SELECT f.flight_quote_sk, f.quote_group_sk, f.as_of_date, r.route_id, f.route_name, r.route_pair_name,
         f.origin_city, f.destination_city, f.airline_name, f.flight_number, f.departure_time_bucket,
         f.arrival_time_bucket, f.stops_label, f.stops_count, f.is_nonstop, f.cabin_class,
         f.duration_hours, f.duration_minutes, f.days_to_departure, f.price_inr,
         {BAND_LABEL_SQL} AS lead_time_bucket, {BAND_RANK_SQL} AS lead_time_bucket_sort,
         {divide_sql("f.price_inr", "f.duration_hours")} AS price_per_hour_inr,
         f.cabin_class = 'Business' AS is_premium_cabin, f.source_file_name, f.ingested_at, f.batch_id
  FROM stg f JOIN routes r ON f.origin_city = r.origin_city AND f.destination_city = r.destination_city),
fact AS (
  SELECT flight_quote_sk, quote_group_sk, as_of_date, route_id, md5(airline_name) AS airline_id,
         flight_number, airline_name, route_name, origin_city, destination_city,
         departure_time_bucket, arrival_time_bucket, stops_label, stops_count, is_nonstop, cabin_class,
         is_premium_cabin, lead_time_bucket, lead_time_bucket_sort, days_to_departure, price_inr,
         price_per_hour_inr, duration_hours, duration_minutes, source_file_name, ingested_at, batch_id
  FROM enriched)"""
)
