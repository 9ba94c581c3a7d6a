"""Every registered query against its SQL on the smallest tables, and the plans that matter."""

from __future__ import annotations

import re

import __spark_entry__ as entry
import pytest
from compare import compare, database
from pyspark.sql import functions as F

from snapstrata.workload import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    rows, problems = compare(spark, con, QUERIES[name], SQL.get(name), SMALL)
    assert not problems, "\n".join(problems)
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and len(frame.columns) == 19


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["check_upper_bound_only"](spark, SMALL).select("l_orderkey"))
    assert "GreaterThan(l_quantity,45.0)" in plan
    assert "struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_lookups_nobody_needs_are_not_joined(spark):
    from snapstrata.workload.base import quotes

    plan = plan_of(quotes(spark, SMALL, ("order_key", "days_left")))
    assert "orders.parquet" in plan
    for other in ("part", "supplier", "customer", "nation"):
        assert f"{other}.parquet" not in plan


def test_lines_are_shuffled_to_their_orders_before_other_lookups_widen_them(spark):
    from snapstrata.workload.base import quotes

    plan = quotes(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [re.search(rf"l_\w+#\d+L? = {key}#", plan).start() for key in ("s_suppkey", "p_partkey", "o_orderkey")]
    # the outermost join comes first
    assert joins == sorted(joins) and "l_tax" not in plan[: plan.index("o_orderkey")]


def test_fact_needs_no_join_beyond_the_quotes(spark):
    from snapstrata.plans import star
    from snapstrata.workload.base import BANDS

    staged = spark.createDataFrame(
        [], QUERIES["staged_quotes"](spark, SMALL).schema
    ).repartition(2)
    plan = plan_of(star.fact_quotes(star.enrich(staged, BANDS)))
    assert "Join" not in plan and plan.count("Exchange") <= 1


def test_bucketed_tables_join_without_a_shuffle(spark):
    from snapstrata.workload.loading import bucketed_lines_and_orders

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(bucketed_lines_and_orders(spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_hot_lookup_key_is_split_by_adaptive_execution(spark):
    """A third of the lines on one part: the shuffled lookup splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("part"),
            F.sha1(F.col("id").cast("string")).alias("payload"),
        )
        parts = spark.range(0, 120_000, 1, 4).select(F.col("id").alias("part"), F.concat(F.lit("x"), F.col("id") < 0).alias("kind"))
        joined = lines.join(parts, "part", "left")
        counted = joined.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("payload"))
        assert [r["n"] for r in counted.collect()] == [120_000]
        plan = plan_of(counted)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in plan
