"""Registered queries: scans, writes, incremental loads, manifest, run log, streaming.

Each writes tables under the session's shared folder, reruns or corrects them,
and returns what a reader finds there afterwards.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from snapstrata.contracts.flights import STAGED_QUOTE, STAGED_REJECT
from snapstrata.operators import merge, reconcile
from snapstrata.operators.validate import OUTCOME, REASON_TEXT
from snapstrata.plans import build, landing
from snapstrata.plans import refine as R
from snapstrata.session import freed_shuffles, passing_areas, work_area
from snapstrata.sources import audit, fingerprint, scan, tables
from snapstrata.streaming import arrivals
from snapstrata.workload.base import (
    FACT_SQL,
    QUOTE_COLUMNS_SQL,
    QUOTES,
    QUOTES_SQL,
    REASON_CASES,
    TICKET_KEY_SQL,
    TICKETS,
    quotes,
    reasons_sql,
    refined,
    refined_sql,
    register,
    table,
)
from snapstrata.workload.modelling import (
    CARRIER_SQL,
    MIX_SQL,
    PERFORMANCE_SQL,
    QUALITY_TAIL_SQL,
)

# An order table with a snapshot per year stands in for a fact: one row per key,
# and the key fixes the snapshot.
KEY, SNAPSHOT = ("o_orderkey",), "as_of_date"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.trunc(F.col("o_orderdate").cast("date"), "year").alias(SNAPSHOT),
    )


ORDERS_SQL = """o AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS price, o_orderstatus,
         CAST(o_orderdate AS DATE) AS ordered, CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date
  FROM orders)"""


def _raised(rows, by="1000.00"):
    return rows.withColumn("price", (F.col("price") + F.lit(by).cast("decimal(14,2)")).cast("decimal(14,2)"))


_FINAL = "SELECT o_orderkey, o_custkey, price, o_orderstatus, ordered, as_of_date FROM final"


@register(
    "WITH "
    + ORDERS_SQL
    + f""", final AS (
  SELECT * REPLACE (CASE WHEN as_of_date = DATE '1998-01-01' AND o_orderstatus <> 'P'
                         THEN CAST(price + 1000 AS DECIMAL(14,2)) ELSE price END AS price) FROM o) {_FINAL}"""
)
def incremental_fact(spark, sf_dir):
    """Load up to 1998, then everything from the watermark on, with corrected 1998 prices.

    The second batch lacks some 1998 keys; delete-and-insert leaves those rows as they were.
    """
    path = work_area(spark, "fact")
    rows = _orders(spark, sf_dir)
    first = rows.where(F.col(SNAPSHOT) <= F.lit(date(1998, 1, 1)))
    tables.load_incrementally(spark, path, first, KEY, SNAPSHOT, mode="delete_insert", keys_stay=True)
    newest = tables.watermark(spark, path, SNAPSHOT)
    later = merge.at_or_after(rows, SNAPSHOT, newest)
    same_day = F.col(SNAPSHOT) == F.lit(newest)
    batch = _raised(later.where(same_day & (F.col("o_orderstatus") != "P"))).unionByName(
        later.where(~same_day)
    )
    tables.load_incrementally(spark, path, batch, KEY, SNAPSHOT, mode="delete_insert", keys_stay=True)
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + f""", final AS (
  SELECT * REPLACE (CASE WHEN as_of_date = DATE '1998-01-01' THEN CAST(price + 1000 AS DECIMAL(14,2)) ELSE price END AS price)
  FROM o WHERE as_of_date <> DATE '1998-01-01' OR o_orderstatus <> 'P') {_FINAL}"""
)
def replaced_snapshot(spark, sf_dir):
    """As ``incremental_fact``, but a batch is the whole truth for its snapshots."""
    path = work_area(spark, "fact")
    rows = _orders(spark, sf_dir)
    first = rows.where(F.col(SNAPSHOT) <= F.lit(date(1998, 1, 1)))
    tables.load_incrementally(spark, path, first, KEY, SNAPSHOT)
    newest = tables.watermark(spark, path, SNAPSHOT)
    later = merge.at_or_after(rows, SNAPSHOT, newest)
    same_day = F.col(SNAPSHOT) == F.lit(newest)
    batch = _raised(later.where(same_day & (F.col("o_orderstatus") != "P"))).unionByName(
        later.where(~same_day)
    )
    tables.load_incrementally(spark, path, batch, KEY, SNAPSHOT)
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + f""", final AS (
  SELECT * REPLACE (CASE WHEN as_of_date >= DATE '1999-01-01' AND o_orderstatus = 'F' THEN CAST(price + 1000 AS DECIMAL(14,2)) ELSE price END AS price,
                    CASE WHEN as_of_date < DATE '1999-01-01' THEN o_orderstatus WHEN o_orderstatus = 'F' THEN 'F' ELSE 'X' END AS o_orderstatus)
  FROM o) {_FINAL}"""
)
def upsert_fact(spark, sf_dir):
    """Matched rows take only the price from the batch; unmatched ones come in whole."""
    path = work_area(spark, "fact")
    rows = _orders(spark, sf_dir)
    recent = F.col(SNAPSHOT) >= F.lit(date(1999, 1, 1))
    settled = F.col("o_orderstatus") == "F"
    tables.load_incrementally(spark, path, rows.where(~recent | settled), KEY, SNAPSHOT)
    raised = F.when(settled, F.col("price") + 1000).otherwise(F.col("price"))
    batch = rows.where(recent).withColumns(
        {"price": raised.cast("decimal(14,2)"), "o_orderstatus": F.lit("X")}
    )
    tables.load_incrementally(
        spark, path, batch, KEY, SNAPSHOT, mode="upsert", update=("price",), keys_stay=True
    )
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + f""", final AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE as_of_date END AS as_of_date,
                    CASE WHEN o_orderkey % 3 = 0 THEN CAST(price + 1000 AS DECIMAL(14,2)) ELSE price END AS price) FROM o) {_FINAL}"""
)
def undated_rows(spark, sf_dir):
    """Orders of one status have no snapshot.  Loaded in three batches, the last one a correction: none is lost."""
    path = work_area(spark, "fact")
    dated = F.when(F.col("o_orderstatus") != "P", F.col(SNAPSHOT)).alias(SNAPSHOT)
    rows = _orders(spark, sf_dir).withColumn(SNAPSHOT, dated)
    odd = F.col("o_orderkey") % 2 == 1
    for batch in (rows.where(odd), rows.where(~odd), _raised(rows.where("o_orderkey % 3 = 0"))):
        tables.load_incrementally(spark, path, batch, KEY, SNAPSHOT, mode="delete_insert", keys_stay=True)
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + f""", final AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN CAST(as_of_date + INTERVAL 1 YEAR AS DATE) ELSE as_of_date END AS as_of_date)
  FROM o) {_FINAL}"""
)
def moved_keys(spark, sf_dir):
    """A correction moves orders to the next snapshot: they leave the one they were loaded into."""
    path = work_area(spark, "fact")
    rows = _orders(spark, sf_dir)
    tables.load_incrementally(spark, path, rows, KEY, SNAPSHOT)
    later = rows.where("o_orderstatus = 'F'").withColumn(SNAPSHOT, F.add_months(SNAPSHOT, 12))
    tables.load_incrementally(spark, path, later, KEY, SNAPSHOT, mode="delete_insert")
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + """, parts AS (
  SELECT *, as_of_date = DATE '1996-01-01' OR as_of_date >= DATE '2000-01-01' AS second FROM o)
SELECT as_of_date, count(*) AS row_count, CAST(sum(price) AS DECIMAL(38,2)) AS total,
       CASE WHEN second THEN 2 ELSE 1 END AS arrival FROM parts GROUP BY ALL"""
)
def late_snapshot(spark, sf_dir):
    """The 1996 snapshot arrives after 1999 was loaded.

    A watermark on the snapshot date would skip it; the arrival number finds it.
    """
    path = work_area(spark, "fact")
    rows = _orders(spark, sf_dir)
    late = (F.col(SNAPSHOT) == F.lit(date(1996, 1, 1))) | (F.col(SNAPSHOT) >= F.lit(date(2000, 1, 1)))
    source = rows.withColumn("arrival", F.when(late, 2).otherwise(1))
    tables.load_incrementally(spark, path, source.where("arrival = 1"), KEY, SNAPSHOT)
    seen = tables.watermark(spark, path, "arrival", "int")
    batch = merge.arrived_since(source, SNAPSHOT, "arrival", seen)
    tables.load_incrementally(spark, path, batch, KEY, SNAPSHOT)
    return (
        spark.read.parquet(path)
        .groupBy(SNAPSHOT, "arrival")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("price").cast("decimal(38,2)").alias("total"),
        )
    )


@register("WITH " + ORDERS_SQL + f", final AS (SELECT * FROM o) {_FINAL}")
def idempotent_write(spark, sf_dir):
    """Writing the same snapshots three times leaves each row once."""
    path = work_area(spark, "snapshots")
    rows = _orders(spark, sf_dir)
    tables.write_partitions(rows, path, by=(SNAPSHOT,), sort=("o_custkey",))
    tables.write_partitions(rows, path, by=(SNAPSHOT,), sort=("o_custkey",))
    one = rows.where(F.col(SNAPSHOT) == F.lit(date(1997, 1, 1)))
    tables.write_partitions(one, path, by=(SNAPSHOT,), sort=("o_custkey",))
    return spark.read.parquet(path)


@register(
    "WITH "
    + ORDERS_SQL
    + f", final AS (SELECT * FROM o WHERE as_of_date <> DATE '1997-01-01') {_FINAL}"
)
def emptied_partition(spark, sf_dir):
    """A rerun that brings no rows for a snapshot it owns clears what was there."""
    path = work_area(spark, "snapshots")
    rows = _orders(spark, sf_dir)
    tables.write_partitions(rows, path, by=(SNAPSHOT,))
    cleared = date(1997, 1, 1)
    none_left = rows.where((F.col(SNAPSHOT) == F.lit(cleared)) & (F.col("price") < 0))
    tables.write_partitions(none_left, path, by=(SNAPSHOT,), owned=[(cleared,)])
    return spark.read.parquet(path)


@register(
    "WITH " + ORDERS_SQL + f", final AS (SELECT * FROM o WHERE as_of_date = DATE '1999-01-01') {_FINAL}"
)
def staged_load(spark, sf_dir):
    """Staging holds exactly the last partition copied into it."""
    path, staging = work_area(spark, "lake"), work_area(spark, "staging")
    tables.write_partitions(_orders(spark, sf_dir), path, by=(SNAPSHOT,))
    tables.load_staging(spark, path, staging, SNAPSHOT, "1998-01-01")
    return tables.load_staging(spark, path, staging, SNAPSHOT, "1999-01-01")


@register("WITH " + ORDERS_SQL + f", final AS (SELECT * FROM o) {_FINAL}")
def hot_cold_union(spark, sf_dir):
    """Recent and archived copies overlap in 1998-1999; the view shows each row once."""
    hot_path, cold_path = work_area(spark, "hot"), work_area(spark, "cold")
    rows = _orders(spark, sf_dir)
    recent = rows.where(F.col(SNAPSHOT) >= F.lit(date(1998, 1, 1)))
    older = rows.where(F.col(SNAPSHOT) <= F.lit(date(1999, 1, 1)))
    tables.write_partitions(recent, hot_path, by=(SNAPSHOT,))
    tables.write_partitions(older, cold_path, by=(SNAPSHOT,))
    hot, cold = spark.read.parquet(hot_path), spark.read.parquet(cold_path)
    return tables.hot_and_cold(hot, cold, SNAPSHOT, "1999-01-01")


@register(
    "WITH "
    + ORDERS_SQL
    + f", final AS (SELECT * FROM o WHERE as_of_date IN (DATE '1998-01-01', DATE '1999-01-01')) {_FINAL}"
)
def external_table(spark, sf_dir):
    """Only registered partitions are visible; registering one twice changes nothing."""
    path = work_area(spark, "external")
    rows = _orders(spark, sf_dir)
    tables.write_partitions(rows, path, by=(SNAPSHOT,))
    name = "orders_" + path.rsplit("-", 1)[-1]
    scan.create_external_table(spark, name, rows.schema, SNAPSHOT, path)
    for day in ("1998-01-01", "1999-01-01", "1998-01-01"):
        place = f"{path}/{SNAPSHOT}={day}"
        scan.register_partition(spark, name, SNAPSHOT, day, place)
    scan.refresh_statistics(spark, name)
    return spark.table(name)


@register(
    """SELECT o_orderpriority, l_linestatus, count(*) AS line_count,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS price_total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
)
def colocated_join(spark, sf_dir):
    """Lines and orders saved in the same buckets by order key, joined without a shuffle."""
    joined = bucketed_lines_and_orders(spark, sf_dir)
    return joined.groupBy("o_orderpriority", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("price").cast("decimal(38,2)").alias("price_total")
    )


#: rows of the larger table that a bucket should hold
BUCKET_ROWS = 1_000_000


def bucketed_lines_and_orders(spark, sf_dir, buckets=None):
    """Both tables in the same buckets: as many as given, or as the lines' number asks for."""
    if buckets is None:
        buckets = max(8, -(-table(spark, sf_dir, "lineitem").count() // BUCKET_ROWS))
    price = F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", price)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    sides = []
    for rows, key in ((lines, "l_orderkey"), (orders, "o_orderkey")):
        path = work_area(spark, "bucketed")
        name = f"bucketed_{path.rsplit('-', 1)[-1]}"
        tables.save_bucketed(rows, name, path, (key,), buckets)
        sides.append(spark.table(name))
    return sides[0].join(sides[1], F.col("l_orderkey") == F.col("o_orderkey"))


# --- text files -------------------------------------------------------------

ORDER_FILE = StructType(
    [
        StructField("order_key", LongType()),
        StructField("customer", LongType()),
        StructField("status", StringType()),
        StructField("price", DecimalType(14, 2)),
        StructField("ordered", DateType()),
        StructField("rank", IntegerType()),
    ]
)
ORDER_CONTRACT = QUOTES.with_options(name="order_file", source_schema=ORDER_FILE, row_number="order_key")


@register(
    """SELECT o_orderkey AS order_key, o_custkey AS customer, o_orderstatus AS status,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_totalprice AS DECIMAL(14,2)) END AS price,
  CAST(o_orderdate AS DATE) AS ordered, CAST(left(o_orderpriority, 1) AS INTEGER) AS rank,
  o_orderpriority = '4-NOT SPECIFIED' AS malformed FROM orders"""
)
def contracted_csv_scan(spark, sf_dir):
    """Orders as CSV with the columns in another order and unreadable prices, read by contract."""
    path = work_area(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    text = orders.select(
        F.left("o_orderpriority", F.lit(1)).alias("rank"),
        F.col("o_orderdate").cast("date").cast("string").alias("ordered"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unknown").otherwise(price).alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderkey").cast("string").alias("order_key"),
    )
    text.write.option("header", True).csv(path)
    rows = scan.scan_csv(spark, path, ORDER_CONTRACT)
    return rows.select(*ORDER_FILE.fieldNames(), F.col(scan.CORRUPT).isNotNull().alias("malformed"))


_DIGEST_SQL = """digests AS (
  SELECT {by} AS k, md5(concat_ws(chr(31), {cols})) AS d FROM {source}),
prints AS (
  SELECT k, count(*) AS row_count,
         md5(concat_ws('|', CAST(count(*) AS VARCHAR),
             CAST(sum(CAST(('0x' || substr(d, 1, 15)) AS BIGINT)) AS VARCHAR),
             CAST(sum(CAST(('0x' || substr(d, 17, 15)) AS BIGINT)) AS VARCHAR))) AS file_hash
  FROM digests GROUP BY k)"""


@register(
    "WITH "
    + _DIGEST_SQL.format(
        by="o_orderstatus", cols="o_orderkey, o_custkey, o_orderpriority", source="orders"
    )
    + " SELECT k AS o_orderstatus, row_count, file_hash FROM prints"
)
def content_fingerprints(spark, sf_dir):
    """One content hash per order status, independent of row order and file layout."""
    rows = table(spark, sf_dir, "orders")
    columns = ("o_orderkey", "o_custkey", "o_orderpriority")
    return fingerprint.table_fingerprint(rows, columns, by=("o_orderstatus",))


def _deliveries(spark, sf_dir):
    """One delivery per day of events and one re-sent copy per event type and day."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("as_of_date"), "event_type", "event_id", "user_id"
    )
    return fingerprint.table_fingerprint(
        events, ("event_id", "user_id"), by=("as_of_date", "event_type")
    )


_DELIVERIES_SQL = (
    """src AS (SELECT CAST(ts AS DATE) AS day, event_type, event_id, user_id FROM events), """
    + _DIGEST_SQL.format(by="(day, event_type)", cols="event_id, user_id", source="src")
    + """, deliveries AS (SELECT k[1] AS as_of_date, k[2] AS event_type, row_count, file_hash FROM prints)"""
)


@register(
    "WITH "
    + _DELIVERIES_SQL
    + """ SELECT as_of_date, event_type, row_count, file_hash,
  CASE WHEN event_type IN ('click', 'view') THEN 'repeat' ELSE 'new' END AS verdict FROM deliveries"""
)
def delivery_verdicts(spark, sf_dir):
    """Deliveries against a written manifest that already knows two of the event types."""
    path = work_area(spark, "manifest")
    found = _deliveries(spark, sf_dir)
    known = found.where(F.col("event_type").isin("click", "view")).select(
        F.concat("event_type", F.lit(".csv")).alias("source_file"),
        "file_hash",
        "as_of_date",
        F.lit("first").alias("batch_id"),
        F.col("row_count").alias("source_row_count"),
        F.lit(audit.now_utc()).alias("ingested_at"),
    )
    tables.append_rows(audit.conform(known, audit.MANIFEST_SCHEMA), path)
    manifest = audit.read_manifest(spark, path)
    fresh = audit.new_deliveries(found, manifest).withColumn("verdict", F.lit("new"))
    again = audit.repeated_deliveries(found, manifest).withColumn("verdict", F.lit("repeat"))
    return fresh.unionByName(again)


def write_refined(spark, sf_dir, contract=TICKETS, path=None):
    """Refine the quotes into a two-sided table, as the refining job does."""
    path = path or work_area(spark, "refined")
    columns = [c for c in contract.output if c != SNAPSHOT]
    # the quotes that were landed for it are of no use once their judged rows are written
    with passing_areas(spark):
        rows = refined(spark, sf_dir, contract).select(*columns, REASON_TEXT, OUTCOME, SNAPSHOT)
        # a few years: every task may write to all of them, and no derived column is shuffled
        tables.write_partitions(rows, path, by=(OUTCOME, SNAPSHOT), sort=(contract.group_column,), balance=False)
    return path


@register(
    "WITH "
    + refined_sql(TICKET_KEY_SQL)
    + f""" SELECT {QUOTE_COLUMNS_SQL}, coalesce(rejection_reason, 'accepted') AS verdict FROM refined"""
)
def split_tables(spark, sf_dir):
    """Both halves of the refined table, written in one pass and read as two tables."""
    split = R.RefinedTables(write_refined(spark, sf_dir))
    good = split.read_valid(spark).withColumn("verdict", F.lit("accepted"))
    bad = split.read_rejected(spark).withColumnRenamed(REASON_TEXT, "verdict")
    return good.unionByName(bad)


RUN_LOG_SQL = (
    refined_sql(TICKET_KEY_SQL)
    + """, counted AS (
  SELECT as_of_date, count(*) AS total, count(*) FILTER (outcome = 'valid') AS good,
         count(*) FILTER (outcome = 'rejected') AS bad,
         count(*) FILTER (rejection_reason = 'duplicate_business_key') AS dup FROM refined GROUP BY 1),
variants AS (
  SELECT as_of_date, count(*) FILTER (n > 1) AS multi FROM (
    SELECT as_of_date, quote_group_sk, count(*) AS n FROM valid GROUP BY 1, 2) GROUP BY 1),
texts AS (
  SELECT as_of_date, '{' || string_agg('"' || rejection_reason || '":' || n, ',' ORDER BY n DESC, rejection_reason) || '}' AS breakdown
  FROM (SELECT as_of_date, rejection_reason, count(*) AS n FROM rejected GROUP BY 1, 2) GROUP BY 1),
run_log AS (
  SELECT 'silver' AS layer, as_of_date, total AS bronze_row_count, good AS silver_valid_count,
         bad AS silver_rejected_count, dup AS duplicates_removed,
         coalesce(multi, 0) AS multi_variant_quote_groups,
         CAST(round(bad * 100.0::DOUBLE / total, 4) AS DECIMAL(9,4)) AS rejected_pct,
         true AS reconciled, coalesce(breakdown, '{}') AS rejection_reason_breakdown
  FROM counted LEFT JOIN variants USING (as_of_date) LEFT JOIN texts USING (as_of_date))"""
)


def run_log(spark, sf_dir):
    """The run log of a refining run over all quotes, one row per snapshot."""
    written = spark.read.parquet(write_refined(spark, sf_dir))
    raw = reconcile.raw_counts(quotes(spark, sf_dir, (SNAPSHOT,)), SNAPSHOT)
    metrics = reconcile.snapshot_metrics(written, raw, TICKETS)
    path = work_area(spark, "run_log")
    audit.append_run_log(spark, audit.run_log_rows(metrics, "silver", "batch-1"), path)
    return audit.read_run_log(spark, path)


@register("WITH " + RUN_LOG_SQL + " SELECT * FROM run_log")
def refining_run_log(spark, sf_dir):
    return run_log(spark, sf_dir).select(
        "layer",
        "as_of_date",
        "bronze_row_count",
        "silver_valid_count",
        "silver_rejected_count",
        "duplicates_removed",
        "multi_variant_quote_groups",
        "rejected_pct",
        "reconciled",
        "rejection_reason_breakdown",
    )


# --- a whole file, from text to gold ----------------------------------------

FARE_FILE = StructType(
    [
        StructField("index", LongType()),
        *[f for f in QUOTES.source_schema.fields if f.name not in ("index", "price")],
        StructField("price", DecimalType(12, 2)),
    ]
)
FARES = QUOTES.with_options(
    name="fare_file",
    source_schema=FARE_FILE,
    tiebreak=(("_ingested_at", "desc"), ("_source_row", "asc")),
)


def write_delivery(text, path, by=()):
    """Rows of text as a delivery, packed as deliveries are."""
    with freed_shuffles(text.sparkSession):
        text.write.partitionBy(*by).option("header", True).option("compression", "gzip").csv(path)


@register(
    "WITH "
    + QUOTES_SQL
    + f""", file AS (
  SELECT * REPLACE (DATE '2024-01-01' AS as_of_date, nullif(airline, '') AS airline) FROM quotes),
judged AS (SELECT *, {reasons_sql(REASON_CASES)} AS own FROM file),
ranked AS (SELECT *, row_number() OVER (
    PARTITION BY flight, source_city, destination_city, departure_time, arrival_time, class, days_left, duration, price
    ORDER BY order_key, line_number, part_key, supp_key, list_price, shipped) AS place FROM judged)
SELECT as_of_date, CASE WHEN place > 1 THEN 'duplicate_business_key' ELSE coalesce(nullif(own, ''), 'accepted') END AS verdict,
       count(*) AS n, CAST(sum(price) AS DECIMAL(38,2)) AS price_total
FROM ranked GROUP BY ALL"""
)
def landed_file(spark, sf_dir):
    """All quotes as one CSV delivery, taken in twice: the repeat must change nothing."""
    inbox = work_area(spark, "inbox")
    text = quotes(spark, sf_dir).select(
        F.xxhash64("order_key", "line_number", "part_key", "supp_key", "list_price", "shipped")
        .cast("string")
        .alias("index"),
        *[f.name for f in FARE_FILE.fields if f.name not in ("index", "price")],
        F.col("price").cast("string").alias("price"),
    )
    write_delivery(text, inbox)
    lake = landing.Lake(work_area(spark, "lake"))
    build.take_in(spark, inbox, FARES, lake, as_of_date="2024-01-01")
    build.take_in(spark, inbox, FARES, lake, as_of_date="2024-01-01")
    split = R.RefinedTables(lake.refined)
    good = split.read_valid(spark).withColumn("verdict", F.lit("accepted"))
    bad = split.read_rejected(spark).withColumnRenamed(REASON_TEXT, "verdict")
    return (
        good.unionByName(bad)
        .groupBy("as_of_date", "verdict")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("price_inr").cast("decimal(38,2)").alias("price_total"),
        )
    )


_GOLD_SUMS = (
    ("fct_flight_price_quote", "fact", "price_inr"),
    ("mart_route_performance", "performance", "quote_count"),
    ("mart_airline_cabin_mix", "mix", "quote_count"),
    ("mart_data_quality_summary", "quality", "rejected_row_count_for_reason"),
)


@register(
    "WITH "
    + FACT_SQL
    + QUALITY_TAIL_SQL
    + ", "
    + ", ".join((PERFORMANCE_SQL, MIX_SQL, CARRIER_SQL))
    + " "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, as_of_date, count(*) AS row_count, "
        f"CAST(sum({measure}) AS DECIMAL(38,2)) AS total FROM {cte} GROUP BY as_of_date"
        for name, cte, measure in _GOLD_SUMS
    )
    + """ UNION ALL SELECT 'dim_airline', NULL, count(*), CAST(sum(quote_count) AS DECIMAL(38,2)) FROM carriers"""
)
def gold_refresh(spark, sf_dir):
    """Gold tables brought up in two steps and refreshed once more, then summed per snapshot."""
    lake = landing.Lake(work_area(spark, "lake"))
    write_refined(spark, sf_dir, QUOTES, lake.refined)

    def refresh(**options):
        # made-up fares: a cabin's mark-up can be anything
        options["ungated"] = ("premium_is_sane",)
        return build.refresh_gold(spark, lake, QUOTES, STAGED_QUOTE, STAGED_REJECT, **options)

    refresh(snapshots=["1997-01-01", "1999-01-01"])
    refresh()
    refresh()
    total = F.sum(F.col("measure").cast("decimal(20,2)")).cast("decimal(38,2)").alias("total")
    parts = [
        spark.read.parquet(f"{lake.gold}/{name}")
        .select("as_of_date", F.col(measure).alias("measure"))
        .groupBy(F.lit(name).alias("table_name"), "as_of_date")
        .agg(F.count(F.lit(1)).alias("row_count"), total)
        for name, _, measure in _GOLD_SUMS
    ]
    carriers = spark.read.parquet(f"{lake.gold}/dim_airline").select(
        F.col("quote_count").alias("measure")
    )
    parts.append(
        carriers.agg(F.count(F.lit(1)).alias("row_count"), total).select(
            F.lit("dim_airline").alias("table_name"),
            F.lit(None).cast("date").alias("as_of_date"),
            "row_count",
            "total",
        )
    )
    return reduce(DataFrame.unionAll, parts)


# --- streams ----------------------------------------------------------------


@register(
    """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS as_of_date FROM events"""
)
def stream_ingest_once(spark, sf_dir):
    """Events streamed into a date-partitioned table; a second run and a replay add nothing."""
    source = table(spark, sf_dir, "events")
    target, seen, again = (work_area(spark, n) for n in ("streamed", "checkpoint", "checkpoint"))

    def stream():
        return (
            spark.readStream.schema(source.schema)
            .option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir)
            .select(
                "event_id",
                "user_id",
                "event_type",
                "value",
                F.col("ts").cast("timestamp").alias("ts"),
                F.col("ts").cast("date").alias("as_of_date"),
            )
        )

    for checkpoint in (seen, seen, again):
        arrivals.merge_arrivals(
            stream(),
            target,
            checkpoint,
            key=("event_id",),
            tiebreak=(("ts", "desc"), ("value", "asc")),
            snapshot="as_of_date",
        )
    return spark.read.parquet(target).drop("ts")


@register(
    """SELECT event_id, user_id, event_type, value,
         CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS as_of_date FROM events"""
)
def stream_undated_rows(spark, sf_dir):
    """Streamed in two batches, with no date on one type of event: those rows have a partition of their own."""
    source = table(spark, sf_dir, "events")
    target = work_area(spark, "streamed")
    dated = F.when(F.col("event_type") != "click", F.col("ts").cast("date")).alias("as_of_date")
    for parity in (0, 1):
        stream = (
            spark.readStream.schema(source.schema)
            .option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir)
            .where(F.col("event_id") % 2 == parity)
            .select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), dated)
        )
        arrivals.merge_arrivals(
            stream,
            target,
            work_area(spark, "checkpoint"),
            key=("event_id",),
            tiebreak=(("ts", "desc"), ("value", "asc")),
            snapshot="as_of_date",
        )
    return spark.read.parquet(target).drop("ts")
