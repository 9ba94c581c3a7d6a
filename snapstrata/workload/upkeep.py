"""Registered queries: deliveries, refinings and refreshes that overlap, rows without a date, keys that move in a stream."""

from __future__ import annotations

import warnings
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.contracts.flights import STAGED_QUOTE, STAGED_REJECT
from snapstrata.operators import merge, monitor
from snapstrata.operators.validate import REASON_TEXT
from snapstrata.plans import build, landing, members, star
from snapstrata.plans.refine import RefinedTables, refine_snapshots
from snapstrata.session import passing_areas, work_area
from snapstrata.sources import audit, drift, scan, tables
from snapstrata.streaming import arrivals
from snapstrata.workload.base import (
    FACT_SQL,
    QUOTE_KEY_SQL,
    QUOTES,
    QUOTES_SQL,
    REASON_CASES,
    TICKET_KEY_SQL,
    TICKETS,
    quotes,
    reasons_sql,
    refined_sql,
    register,
    stored,
    table,
)
from snapstrata.workload.loading import FARE_FILE, FARES, ORDER_CONTRACT, ORDER_FILE, write_delivery
from snapstrata.workload.modelling import CARRIER_SQL, ROUTE_SQL, fact

SNAPSHOT = "as_of_date"
#: made-up fares: a cabin's mark-up can be anything
UNGATED = ("premium_is_sane",)


def deliver(spark, lake, rows, batch_id):
    """Rows as one delivery for each of their snapshots: data first, then the manifest, as a landing does."""
    rows = rows.withColumn("_batch_id", F.lit(batch_id))
    # a few years: every task may write to all of them
    written = tables.write_partitions(rows, lake.raw, by=(SNAPSHOT,), balance=False)
    days = [None if name.endswith(tables.NO_VALUE) else date.fromisoformat(name.partition("=")[2]) for name in written]
    # counted where they lie now: ``rows`` would be computed once more
    entries = landed(spark, lake).where(merge.in_snapshots(SNAPSHOT, days)).groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("source_row_count"))
    audit.record_deliveries(entries.withColumn("batch_id", F.lit(batch_id)), lake.manifest)


def landed(spark, lake):
    return spark.read.parquet(lake.raw).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))


def redeliver(spark, lake, where, batch_id):
    """Some of the rows that lie in the raw layer once more, as a delivery of their own."""
    with passing_areas(spark):
        deliver(spark, lake, stored(landed(spark, lake).where(where), "delivery"), batch_id)


def refine_waiting(spark, lake, contract, after_write=None):
    days = build.unrefined(spark, lake)
    refine_snapshots(
        spark, lake.raw, lake.refined, lake.run_log, contract, snapshots=days, manifest_path=lake.manifest, after_write=after_write
    )


def over_lines(sql, where):
    """The same SQL on the lines that a condition keeps."""
    return sql.replace("FROM lineitem\n", f"FROM (SELECT * FROM lineitem WHERE {where}) lineitem\n")


#: a second delivery of the 1997 snapshot lacks the first line of every order
CORRECTED = "l_linenumber <> 1 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997)"


def _correct(spark, lake):
    redeliver(spark, lake, (F.col(SNAPSHOT) == "1997-01-01") & (F.col("line_number") != 1), "second")


@register(
    "WITH "
    + over_lines(FACT_SQL, CORRECTED)
    + """ SELECT as_of_date, count(*) AS row_count, CAST(sum(price_inr) AS DECIMAL(38,2)) AS total FROM fact GROUP BY as_of_date"""
)
def refine_during_refresh(spark, sf_dir):
    """1997 is delivered and refined anew while the first refresh is under way: the second one takes it up."""
    lake = landing.Lake(work_area(spark, "lake"))
    deliver(spark, lake, quotes(spark, sf_dir), "first")
    refine_waiting(spark, lake, QUOTES)

    def meanwhile():
        _correct(spark, lake)
        refine_waiting(spark, lake, QUOTES)

    build.refresh_gold(spark, lake, QUOTES, STAGED_QUOTE, STAGED_REJECT, ungated=UNGATED, after_write=meanwhile)
    build.refresh_gold(spark, lake, QUOTES, STAGED_QUOTE, STAGED_REJECT, ungated=UNGATED)
    fact = spark.read.parquet(f"{lake.gold}/fct_flight_price_quote")
    total = F.sum("price_inr").cast("decimal(38,2)").alias("total")
    return fact.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"), total)


@register(
    "WITH "
    + over_lines(refined_sql(TICKET_KEY_SQL), CORRECTED)
    + """ SELECT as_of_date, coalesce(rejection_reason, 'accepted') AS verdict, count(*) AS row_count FROM refined GROUP BY ALL"""
)
def landing_during_refine(spark, sf_dir):
    """1997 is delivered anew while its first delivery is being refined: the next refining takes it up."""
    lake = landing.Lake(work_area(spark, "lake"))
    deliver(spark, lake, quotes(spark, sf_dir), "first")
    refine_waiting(spark, lake, TICKETS, after_write=lambda: _correct(spark, lake))
    refine_waiting(spark, lake, TICKETS)
    return _verdicts(spark, lake).groupBy(SNAPSHOT, "verdict").agg(F.count(F.lit(1)).alias("row_count"))


def _verdicts(spark, lake):
    split = RefinedTables(lake.refined)
    good = split.read_valid(spark).withColumn("verdict", F.lit("accepted"))
    return good.unionByName(split.read_rejected(spark).withColumnRenamed(REASON_TEXT, "verdict"))


_UNDATED_SQL = over_lines(
    FACT_SQL, "l_linenumber <> 1 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW')"
).replace(
    "CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date",
    "CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS as_of_date",
)


@register(
    "WITH "
    + _UNDATED_SQL
    + """ SELECT 'refined' AS layer, as_of_date, count(*) AS row_count, CAST(sum(price_inr) AS DECIMAL(38,2)) AS total FROM refined GROUP BY as_of_date
    UNION ALL SELECT 'fact', as_of_date, count(*), CAST(sum(price_inr) AS DECIMAL(38,2)) FROM fact GROUP BY as_of_date"""
)
def undated_snapshot(spark, sf_dir):
    """Quotes of one priority have no snapshot date: refined, delivered anew, refined and loaded as a partition of their own."""
    lake = landing.Lake(work_area(spark, "lake"))
    dated = F.when(F.col("departure_time") != "5-LOW", F.col(SNAPSHOT))
    ungated = (*UNGATED, "not_null_as_of_date", "not_null_fct_flight_price_quote_as_of_date")

    def refresh():
        build.refresh_gold(spark, lake, QUOTES, STAGED_QUOTE, STAGED_REJECT, ungated=ungated)

    deliver(spark, lake, quotes(spark, sf_dir).withColumn(SNAPSHOT, dated), "first")
    refine_waiting(spark, lake, QUOTES)
    refresh()
    redeliver(spark, lake, F.col(SNAPSHOT).isNull() & (F.col("line_number") != 1), "second")
    refine_waiting(spark, lake, QUOTES)
    refresh()
    layers = {"refined": _verdicts(spark, lake), "fact": spark.read.parquet(f"{lake.gold}/fct_flight_price_quote")}
    total = F.sum("price_inr").cast("decimal(38,2)").alias("total")
    sums = [
        rows.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"), total).select(F.lit(layer).alias("layer"), "*")
        for layer, rows in layers.items()
    ]
    return reduce(DataFrame.unionAll, sums)


@register(
    """SELECT event_id, user_id, event_type, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value,
  CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS as_of_date
  FROM events"""
)
def stream_moved_keys(spark, sf_dir):
    """Corrections in a stream move events to the next day, or take their date away; older corrections change nothing."""
    source = table(spark, sf_dir, "events")
    target = work_area(spark, "streamed")
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    later, earlier = ts + F.expr("INTERVAL 1 HOUR"), ts - F.expr("INTERVAL 1 HOUR")
    day = F.col("ts").cast("date")
    new_day = F.when(kind == "view", F.date_add(day, 1)).when(kind != "click", day)
    batches = [
        (F.lit(True), ts, day, F.col("value")),
        (kind.isin("view", "click"), later, new_day, F.when(kind == "click", F.col("value") + 1).otherwise(F.col("value"))),
        (F.lit(True), earlier, F.date_add(day, 30), F.col("value") - 1),
    ]
    for chosen, at, snapshot, value in batches:
        stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        rows = stream.where(chosen).select("event_id", "user_id", "event_type", value.alias("value"), at.alias("at"), snapshot.alias(SNAPSHOT))
        arrivals.merge_arrivals(
            rows, target, work_area(spark, "checkpoint"), key=("event_id",), tiebreak=(("at", "desc"),), snapshot=SNAPSHOT
        )
    return spark.read.parquet(target).drop("at")


_VERSIONS_SQL = """versions AS (
  SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders)"""


@register(
    "WITH "
    + _VERSIONS_SQL
    + """ SELECT 'after a failure' AS moment, as_of_date, count(*) AS row_count, CAST(sum(price) AS DECIMAL(38,2)) AS total FROM versions GROUP BY as_of_date
  UNION ALL SELECT 'after the repeat', as_of_date, count(*), CAST(sum(CASE WHEN as_of_date >= DATE '1998-01-01' THEN price + 1000 ELSE price END) AS DECIMAL(38,2))
  FROM versions WHERE as_of_date < DATE '1998-01-01' OR o_orderstatus <> 'P' GROUP BY as_of_date"""
)
def published_versions(spark, sf_dir):
    """A second version of some snapshots fails between write and publication, then goes through: no reader sees a mixture."""
    root = work_area(spark, "published")
    name = f"published_{root.rsplit('-', 1)[-1]}"
    price = F.col("o_totalprice").cast("decimal(14,2)").alias("price")
    day = F.trunc(F.col("o_orderdate").cast("date"), "year").alias(SNAPSHOT)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", price, day)
    tables.publish_snapshots(spark, name, rows, root, SNAPSHOT)
    raised = (F.col("price") + 1000).cast("decimal(14,2)")
    newer = rows.where((F.col(SNAPSHOT) >= "1998-01-01") & (F.col("o_orderstatus") != "P")).withColumn("price", raised)

    def fail():
        raise InterruptedError("between write and publication")

    def seen(moment):
        sums = [F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("decimal(38,2)").alias("total")]
        return stored(spark.table(name).groupBy(SNAPSHOT).agg(*sums), "seen").select(F.lit(moment).alias("moment"), "*")

    try:
        tables.publish_snapshots(spark, name, newer, root, SNAPSHOT, before_publish=fail)
    except InterruptedError:
        after_failure = seen("after a failure")
    tables.publish_snapshots(spark, name, newer, root, SNAPSHOT)
    return after_failure.unionAll(seen("after the repeat"))


def _parts(spark, sf_dir):
    """Parts of dimensions, stored in two steps that share a snapshot."""
    root = work_area(spark, "parts")
    cube = stored(star.fare_cube(fact(spark, sf_dir)), "cube")
    members.store_parts(spark, root, cube.where(F.col(SNAPSHOT) <= "1997-01-01"))
    members.store_parts(spark, root, cube.where(F.col(SNAPSHOT) >= "1997-01-01"))
    return root


@register("WITH " + FACT_SQL + ", " + CARRIER_SQL + " SELECT * FROM carriers")
def carriers_from_bitmaps(spark, sf_dir):
    """The carrier dimension after an incremental step, from sums and bitmaps that are stored per snapshot."""
    return members.dim_carrier(spark, _parts(spark, sf_dir))


@register("WITH " + FACT_SQL + ", " + ROUTE_SQL + " SELECT * FROM route_dim")
def routes_from_bitmaps(spark, sf_dir):
    """The route dimension, in the same way."""
    return members.dim_route(spark, _parts(spark, sf_dir))


_REPLACED = "l_linenumber <> 1 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1998)"


@register(
    "WITH "
    + over_lines(QUOTES_SQL, _REPLACED)
    + f""", file AS (SELECT * REPLACE (nullif(airline, '') AS airline) FROM quotes),
judged AS (SELECT *, {reasons_sql(REASON_CASES)} AS own FROM file),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {QUOTE_KEY_SQL} ORDER BY order_key, line_number, part_key, supp_key, list_price, shipped) AS place FROM judged)
SELECT as_of_date, CASE WHEN place > 1 THEN 'duplicate_business_key' ELSE coalesce(nullif(own, ''), 'accepted') END AS verdict,
       count(*) AS n, CAST(sum(price) AS DECIMAL(38,2)) AS price_total FROM ranked GROUP BY ALL"""
)
def inbox_of_deliveries(spark, sf_dir):
    """All snapshots as text deliveries at once, one of them twice under another name and one replaced; then all again."""
    inbox = work_area(spark, "inbox")
    columns = [f.name for f in FARE_FILE.fields if f.name not in ("index", "price")]
    index = F.xxhash64("order_key", "line_number", "part_key", "supp_key", "list_price", "shipped").cast("string").alias("index")
    with passing_areas(spark):
        text = stored(quotes(spark, sf_dir).select(index, *columns, F.col("price").cast("string").alias("price"), SNAPSHOT, "line_number"), "text")
        write_delivery(text.drop("line_number"), f"{inbox}/first", by=(SNAPSHOT,))
        days = sorted(r[0].isoformat() for r in text.select(SNAPSHOT).distinct().collect())

        def write(day, rows, name):
            write_delivery(rows.where(F.col(SNAPSHOT) == day).drop(SNAPSHOT, "line_number"), f"{inbox}/{name}")

        # in other parts and another order than at first
        write("1997-01-01", text.repartition("index"), "again")
        write("1998-01-01", text.where("line_number <> 1"), "corrected")
    deliveries = [(f"{inbox}/first/{SNAPSHOT}={day}", day) for day in days]
    deliveries += [(f"{inbox}/again", "1997-01-01"), (f"{inbox}/corrected", "1998-01-01")]
    lake = landing.Lake(work_area(spark, "lake"))
    for _ in range(2):
        build.take_in_all(spark, deliveries, FARES, lake)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("price_inr").cast("decimal(38,2)").alias("price_total")]
    return _verdicts(spark, lake).groupBy(SNAPSHOT, "verdict").agg(*sums)


@register("SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS at FROM events")
def stream_repeats_dropped(spark, sf_dir):
    """Every event arrives twice, in two files of a stream; the guard lets one of each through."""
    source, target = work_area(spark, "repeated"), work_area(spark, "once")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    for _ in range(2):
        rows.write.mode("append").parquet(source)
    once = arrivals.drop_repeats(spark.readStream.schema(rows.schema).parquet(source), "at", ("event_id",), "1 hour")
    arrivals.run_available(once, lambda batch, _: batch.write.mode("append").parquet(target), work_area(spark, "checkpoint"))
    return spark.read.parquet(target)


@register(
    """SELECT o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 'unexpected_columns: amount; missing_columns: price' ELSE 'taken' END AS verdict,
  CASE WHEN o_orderstatus <> 'P' THEN count(*) ELSE 0 END AS row_count,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(38,2)) END AS total FROM orders GROUP BY o_orderstatus"""
)
def gated_headers(spark, sf_dir):
    """Orders as one file per status: with the contract's header, with another order, and with a renamed column, which is refused."""
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"),
        price.alias("price"), F.col("o_orderdate").cast("date").alias("ordered"), F.lit(1).alias("rank"),
    )
    names = ORDER_FILE.fieldNames()
    headers = {"F": [F.col(n) for n in names], "O": [F.col(n) for n in reversed(names)], "P": [F.col(n).alias("amount" if n == "price" else n) for n in names]}
    seen = []
    for status, columns in headers.items():
        path = work_area(spark, "headers")
        orders.where(F.col("o_orderstatus") == status).select(*columns).write.option("header", True).csv(path)
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                rows, verdict = scan.scan_csv(spark, path, ORDER_CONTRACT), "taken"
        except drift.SchemaDriftError as error:
            rows, verdict = None, str(error).split(": ", 1)[1]
        if rows is None:
            sums = spark.range(1).select(F.lit(0).cast("long").alias("row_count"), F.lit(None).cast("decimal(38,2)").alias("total"))
        else:
            sums = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("decimal(38,2)").alias("total"))
        seen.append(sums.select(F.lit(status).alias("o_orderstatus"), F.lit(verdict).alias("verdict"), "row_count", "total"))
    return reduce(DataFrame.unionAll, seen)


_MEASURED = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@register(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls,
  {f"CAST(min({c}) AS VARCHAR)" if c != "l_returnflag" else "NULL"} AS min_value,
  {f"CAST(max({c}) AS VARCHAR)" if c != "l_returnflag" else "NULL"} AS max_value FROM lineitem"""
        for c in _MEASURED
    )
)
def stored_statistics(spark, sf_dir):
    """What the catalog holds about the columns of a table of lines, for plans to go by; texts have no ends there."""
    path = work_area(spark, "measured")
    name = f"measured_{path.rsplit('-', 1)[-1]}"
    table(spark, sf_dir, "lineitem").select(*_MEASURED).write.format("parquet").option("path", path).saveAsTable(name)
    scan.refresh_statistics(spark, name, columns=_MEASURED)
    return scan.column_statistics(spark, name, _MEASURED)


@register(
    " UNION ALL ".join(
        f"""SELECT '{k}' AS key_column, CAST({k} AS VARCHAR) AS key_value, count(*) AS row_count FROM lineitem
  GROUP BY {k} HAVING count(*) * 500 >= (SELECT count(*) FROM lineitem)"""
        for k in ("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_returnflag")
    )
)
def hot_keys(spark, sf_dir):
    """Key values that hold a five-hundredth of the lines or more, counted exactly among sketched candidates."""
    keys = ("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return monitor.hot_keys(table(spark, sf_dir, "lineitem"), keys, 1, 500)


def clustered_lines(spark, sf_dir, files=24):
    """Where lines lie clustered by part within ship years."""
    path = work_area(spark, "clustered")
    rows = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    tables.write_partitions(rows, path, by=("ship_year",), cluster=("l_partkey",), files=files)
    return path


#: a stretch of parts, about a fiftieth of all
PARTS = "l_partkey BETWEEN (SELECT max(l_partkey) FROM lineitem) // 2 AND (SELECT max(l_partkey) FROM lineitem) * 52 // 100"


@register(
    f"""SELECT year(l_shipdate)::INTEGER AS ship_year, count(*) AS line_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(38,2)) AS total
  FROM lineitem WHERE {PARTS} GROUP BY 1"""
)
def clustered_lookup(spark, sf_dir):
    """A stretch of parts out of lines that lie clustered by part: the files' statistics leave few of them to read."""
    last = table(spark, sf_dir, "lineitem").agg(F.max("l_partkey")).first()[0]
    lines = spark.read.parquet(clustered_lines(spark, sf_dir)).where(F.col("l_partkey").between(last // 2, last * 52 // 100))
    total = F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("decimal(38,2)").alias("total")
    return lines.groupBy("ship_year").agg(F.count(F.lit(1)).alias("line_count"), total)
