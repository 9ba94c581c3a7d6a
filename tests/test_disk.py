"""What is written on the way to a result does not pile up."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import dedupe
from snapstrata.session import FREED, passing_areas, shared_dir, work_area
from snapstrata.sources import scan, tables
from snapstrata.workload import QUERIES, loading, upkeep
from snapstrata.workload.base import QUOTES, TICKETS, quotes, stored

SMALL = "/root/testdata/sf0.001"


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def areas(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("snapstrata/*")}


@pytest.mark.parametrize("write", [lambda rows, path: stored(rows, "rows"), lambda rows, path: tables.write_partitions(rows, path, by=("k",))])
def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path, write):
    rows = spark.range(0, 20_000).selectExpr("id % 3 AS k", "sha1(string(id)) AS payload").repartition(5, "payload")
    before, setting = shuffle_files(spark), spark.conf.get(FREED)
    write(rows, str(tmp_path / "t"))
    until = time.monotonic() + 10
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(FREED) == setting
    assert rows.count() == 20_000


def test_the_search_for_winners_shuffles_no_value_of_the_key(spark, monkeypatch):
    seen = []
    found = dedupe._winners
    monkeypatch.setattr(dedupe, "_winners", lambda placed, *path: seen.append(placed.select("_hk", "_dk").dtypes) or found(placed, *path))
    marked = dedupe.mark_winners(quotes(spark, SMALL), QUOTES.business_key, QUOTES.tiebreak)
    assert seen == [[("_hk", "bigint"), ("_dk", "bigint")]] and marked.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_keys_that_spark_hashes_alike_are_told_apart(spark):
    """Spark's hash leaves NULLs out: (NULL, 'a') and ('a', NULL) have the same.  0.0 and -0.0 are one value, as in a group."""
    keys = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), (None, None, None), (None, "a", None), ("", "a", 0.0), ("a", None, 0.0)]
    rows = spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "k1 string, k2 string, k3 double, n int")
    marked = dedupe.mark_winners(rows, ("k1", "k2", "k3"), (("n", "asc"),))
    assert sorted(r["n"] for r in marked.where("_kept").collect()) == [0, 1, 3, 4, 5]


def test_lines_are_not_shuffled_to_parts_beyond_the_broadcast_limit(spark):
    larger = "/root/testdata/sf0.01"
    told = [F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))]
    expected = quotes(spark, larger).agg(*told).first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12k")
    try:
        rows = quotes(spark, larger)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        got = rows.agg(*told).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(l_partkey" not in plan and "hashpartitioning(o_custkey" not in plan
    assert got == expected


def test_passing_areas_are_deleted(spark):
    with passing_areas(spark):
        path = work_area(spark, "rows")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert not Path(path.removeprefix("file:")).exists() and "/passing-" not in work_area(spark, "rows")


@pytest.mark.parametrize("contract", [QUOTES, TICKETS])
def test_a_written_refined_table_leaves_nothing_else(spark, contract):
    before = areas(spark)
    path = loading.write_refined(spark, SMALL, contract)
    assert areas(spark) - before == {path.rsplit("/", 1)[-1]}
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


@pytest.mark.parametrize("name", ["refine_during_refresh", "landing_during_refine", "undated_snapshot"])
def test_raw_rows_of_a_lake_are_stored_once(spark, name):
    before = areas(spark)
    QUERIES[name](spark, SMALL)
    assert {a.rsplit("-", 1)[0] for a in areas(spark) - before} == {"lake"}


def test_an_inbox_leaves_its_deliveries_and_the_lake(spark):
    before = areas(spark)
    upkeep.inbox_of_deliveries(spark, SMALL)
    assert sorted(a.rsplit("-", 1)[0] for a in areas(spark) - before) == ["inbox", "lake"]


def test_deliveries_are_packed_and_read_as_they_were(spark, tmp_path):
    path = str(tmp_path / "inbox")
    rows = spark.range(0, 3000).select(*[F.col("id").cast("string").alias(f.name) if f.name == "order_key" else F.lit(None).cast("string").alias(f.name) for f in loading.ORDER_FILE])
    loading.write_delivery(rows, path)
    parts = [p.name for p in Path(path).glob("part-*")]
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    assert sorted(r["order_key"] for r in scan.scan_csv(spark, path, loading.ORDER_CONTRACT).collect()) == list(range(3000))
