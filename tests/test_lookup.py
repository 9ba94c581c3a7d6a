from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import lookup
from snapstrata.operators.lookup import look_up


@pytest.fixture
def small_limit(spark):
    """Above what the tables of these tests take, but for a stretch or two of codes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def tables(spark, tmp_path, keys):
    """Lines with dangling and missing references, and a table of parts."""
    path = str(tmp_path / "parts")
    kind = "CASE WHEN id % 7 > 0 THEN concat('kind ', id % 5) END AS kind"
    keys.selectExpr("id AS part", kind, "CAST(id % 3 AS INT) AS size", "CAST(id % 2 AS DECIMAL(5,2)) AS rate").write.parquet(path)
    lines = spark.range(0, 6000, 1, 4).selectExpr("id AS line", "CASE WHEN id % 11 > 0 THEN id % 2600 - 100 END AS l_part")
    return lines, spark.read.parquet(path)


def both(lines, parts):
    out, plain = look_up(lines, "l_part", parts, "part"), lines.join(parts, F.col("l_part") == F.col("part"), "left")
    assert out.columns == plain.columns and out.dtypes == plain.dtypes
    got = sorted(map(repr, out.collect()))
    assert got == sorted(map(repr, plain.collect()))
    return out._jdf.queryExecution().executedPlan().toString()


def test_values_of_a_large_table_come_without_moving_a_row(spark, tmp_path, small_limit):
    """Keys below zero, gaps between keys, a missing stretch, NULL values and a NULL key: in several tables of codes."""
    keys = spark.range(-100, 2400).where("id % 4 <> 1 AND (id < 512 OR id > 1100)").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    plan = both(*tables(spark, tmp_path, keys))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_key_that_repeats_is_joined_to_each_of_its_rows(spark, tmp_path, small_limit):
    keys = spark.range(0, 2400).unionAll(spark.range(30, 40))
    assert "SortMergeJoin" in both(*tables(spark, tmp_path, keys))


def test_sparse_keys_and_many_kinds_are_joined(spark, tmp_path, small_limit, monkeypatch):
    lines, parts = tables(spark, tmp_path, spark.range(0, 2400).selectExpr("id * 1000 AS id"))
    assert "SortMergeJoin" in both(lines, parts)
    monkeypatch.setattr(lookup, "MOST_KINDS", 3)
    lines, parts = tables(spark, tmp_path / "more", spark.range(0, 2400))
    assert "SortMergeJoin" in both(lines, parts)


def test_a_small_table_and_inexact_values_are_left_to_spark(spark, tmp_path):
    lines, parts = tables(spark, tmp_path, spark.range(0, 2400))
    both(lines, parts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    try:
        assert "_codes" not in both(lines, parts.withColumn("rate", F.col("rate").cast("double")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
