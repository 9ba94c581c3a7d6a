from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import merge
from snapstrata.session import shared_dir, work_area
from snapstrata.sources import audit, tables

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = "k string, v int, d date"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, path):
    return sorted((r["k"], r["v"], r["d"]) for r in spark.read.parquet(path).collect())


def test_only_partitions_in_the_batch_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, by=("d",))
    filled = tables.write_partitions(frame(spark, ("c", 3, D2)), path, by=("d",))
    assert filled == ["d=2024-01-02"]
    assert content(spark, path) == [("a", 1, D1), ("c", 3, D2)]


def test_owned_partition_without_rows_is_emptied_and_stays_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, by=("d",))
    tables.write_partitions(frame(spark, ("c", 3, D2)), path, by=("d",), owned=[(D1,), (D2,)])
    assert content(spark, path) == [("c", 3, D2)]
    leaf = spark.read.parquet(f"{path}/d=2024-01-01")
    assert leaf.count() == 0 and leaf.columns == ["k", "v"]


def test_a_table_can_start_out_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(frame(spark), path, by=("d",), owned=[(D1,)])
    assert spark.read.parquet(path).count() == 0


def test_two_level_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    owned = [("x", D1), ("y", D1)]
    rows = frame(spark, ("x", 1, D1))
    tables.write_partitions(rows, path, by=("k", "d"), owned=owned)
    assert spark.read.parquet(f"{path}/k=x").count() == 1
    assert spark.read.parquet(f"{path}/k=y").count() == 0


def test_delete_insert_keeps_keys_the_batch_lacks(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2))
    tables.load_incrementally(spark, path, first, ("k",), "d")
    batch = frame(spark, ("a", 10, D1))
    tables.load_incrementally(spark, path, batch, ("k",), "d", mode="delete_insert")
    assert content(spark, path) == [("a", 10, D1), ("b", 2, D1), ("c", 3, D2)]


def test_replace_drops_keys_that_vanished(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_incrementally(
        spark, path, frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2)), ("k",), "d"
    )
    tables.load_incrementally(spark, path, frame(spark, ("a", 10, D1)), ("k",), "d")
    assert content(spark, path) == [("a", 10, D1), ("c", 3, D2)]


def test_upsert_updates_named_columns_only(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    batch = spark.createDataFrame([("a", None, "new"), ("c", 3, "z")], "k string, v int, w string")
    got = sorted(tuple(r) for r in merge.upsert(target, batch, ("k",), ("v",)).collect())
    assert got == [("a", None, "x"), ("b", 2, "y"), ("c", 3, "z")]


def test_reloading_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, ("a", 1, D1), ("b", 2, D2))
    for mode in ("replace", "delete_insert", "upsert"):
        tables.load_incrementally(spark, path, batch, ("k",), "d", mode=mode, update=("v",))
        assert content(spark, path) == [("a", 1, D1), ("b", 2, D2)]
    with pytest.raises(ValueError, match="unknown load mode"):
        tables.load_incrementally(spark, path, batch, ("k",), "d", mode="other")


def test_watermarks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.watermark(spark, path, "d") is None
    tables.write_partitions(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, by=("d",))
    assert tables.watermark(spark, path, "d") == D2
    rows = frame(spark, ("a", 1, D1), ("b", 2, D2), ("c", 3, D3))
    assert merge.at_or_after(rows, "d", D2).count() == 2
    assert merge.at_or_after(rows, "d", None).count() == 3


def test_late_snapshot_is_found_by_arrival(spark):
    rows = spark.createDataFrame(
        [(D1, 5, "late"), (D1, 1, "old"), (D2, 1, "old"), (D3, 5, "new")], "d date, at int, n string"
    )
    fresh = merge.arrived_since(rows, "d", "at", 1)
    assert sorted((r["d"], r["n"]) for r in fresh.collect()) == [
        (D1, "late"),
        (D1, "old"),
        (D3, "new"),
    ]


def test_replace_snapshots_on_frames(spark):
    target = frame(spark, ("a", 1, D1), ("b", 2, D2), ("n", 0, None))
    got = merge.replace_snapshots(target, frame(spark, ("z", 9, D1)), "d")
    assert sorted(r["k"] for r in got.collect()) == ["b", "n", "z"]


def test_missing_control_table_is_empty_but_a_broken_one_is_an_error(spark, tmp_path):
    assert audit.read_manifest(spark, str(tmp_path / "none")).count() == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        audit.read_manifest(spark, str(broken)).count()


def test_manifest_probe_is_per_content_and_snapshot(spark, tmp_path):
    path = str(tmp_path / "manifest")
    entry = dict(source_file="f", file_hash="h1", as_of_date=D1, batch_id="b", source_row_count=3)
    audit.record_deliveries(spark.createDataFrame([entry]), path)
    manifest = audit.read_manifest(spark, path)
    assert audit.already_ingested(manifest, "h1", D1)
    assert not audit.already_ingested(manifest, "h1", D2)
    assert not audit.already_ingested(manifest, "h2", D1)


def test_run_log_has_one_shape_for_all_layers(spark, tmp_path):
    path = str(tmp_path / "log")
    bronze = spark.createDataFrame([(D1, 3, 3, True)], "as_of_date date, source_row_count long, bronze_row_count long, reconciled boolean")
    silver = spark.createDataFrame([(D1, 3, 2, 1)], "as_of_date date, bronze_row_count long, silver_valid_count long, silver_rejected_count long")
    audit.append_run_log(spark, audit.run_log_rows(bronze, "bronze", "b1"), path)
    audit.append_run_log(spark, audit.run_log_rows(silver, "silver", "b1"), path)
    log = audit.read_run_log(spark, path)
    assert {r["layer"]: r["silver_valid_count"] for r in log.collect()} == {"bronze": None, "silver": 2}


def test_hot_and_cold(spark):
    hot = frame(spark, ("a", 1, D2), ("b", 2, D3))
    cold = frame(spark, ("z", 0, D1), ("a", 1, D2))
    rows = tables.hot_and_cold(hot, cold, "d", "2024-01-02").collect()
    assert sorted(r["k"] for r in rows) == ["a", "b", "z"]


def test_work_areas_live_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named.rstrip("/")
    a, b = work_area(spark, "x"), work_area(spark, "x")
    assert a != b and a.startswith(named)


def test_a_large_partition_is_split_over_files(spark, tmp_path):
    """The rebalance hint spreads one hot partition over several writers."""
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.col("id").cast("int").alias("v"),
            F.lit(D1).alias("d"),
        )
        tables.write_partitions(rows, path, by=("d",), sort=("v",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).select("_metadata.file_name").distinct().count()
    assert files > 1
    assert spark.read.parquet(path).count() == 200_000


def test_the_sort_of_a_file_survives_the_writer(spark, tmp_path):
    """Rows of several partitions in one task: each file still holds them in the order asked for."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 4000, 1, 1).selectExpr("id * 7919 % 4001 AS v", "IF(id % 3 = 0, 'a', 'b') AS d")
    tables.write_partitions(rows, path, by=("d",), sort=("v",), balance=False)
    for day in "ab":
        (part,) = (tmp_path / "t" / f"d={day}").glob("*.parquet")
        found = [r["v"] for r in spark.read.parquet(str(part)).select("v", "_metadata.row_index").orderBy("row_index").collect()]
        assert found == sorted(found) and len(found) > 1000


class _Unset:
    """Stands in for a session whose cluster names no shared folder."""

    def __init__(self, master):
        self.master, self.made = master, None
        self.conf = self.sparkContext = self

    def get(self, _key, default):
        return default

    def setCheckpointDir(self, path):
        self.made = path

    def getCheckpointDir(self):
        return self.made


def test_without_a_named_folder_only_local_mode_makes_its_own():
    local = _Unset("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.made
    for cluster in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(_Unset(cluster))


def test_an_upsert_refuses_a_batch_that_repeats_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_incrementally(spark, path, frame(spark, ("a", 1, D1)), ("k",), "d")
    twice = frame(spark, ("a", 2, D1), ("a", 3, D1))
    with pytest.raises(ValueError, match="2 times"):
        tables.load_incrementally(spark, path, twice, ("k",), "d", mode="upsert", update=("v",))
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [1]


@pytest.mark.parametrize("mode", ["replace", "delete_insert", "upsert"])
def test_rows_without_a_snapshot_stay(spark, tmp_path, mode):
    path = str(tmp_path / "t")
    for batch in (frame(spark, ("a", 1, None), ("b", 2, D1)), frame(spark, ("c", 3, D1), ("e", 5, D2))):
        tables.load_incrementally(spark, path, batch, ("k",), "d", mode=mode, update=("v",))
    kept = {r["k"] for r in spark.read.parquet(path).collect()}
    assert kept == ({"a", "c", "e"} if mode == "replace" else {"a", "b", "c", "e"})
    tables.load_incrementally(spark, path, frame(spark, ("f", 6, None)), ("k",), "d", mode=mode, update=("v",))
    kept = {r["k"] for r in spark.read.parquet(path).collect()}
    assert kept == ({"f", "c", "e"} if mode == "replace" else {"a", "b", "c", "e", "f"})
