from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import checks, monitor, profile, reconcile
from snapstrata.operators.faults import Fault, inject_faults

DAY = date(2024, 1, 1)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_basic_table_tests(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "c", 50)], "k int, s string, n int")
    assert checks.not_null(df, "n").count() == 1
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert rows(checks.accepted_values(df, "s", ["a", "b"])) == [("c", 1)]
    assert checks.accepted_range(df, "n", 1, 10).count() == 1
    assert checks.accepted_range(df, "n", low=1).count() == 0
    assert checks.accepted_range(df, "n").count() == 0
    assert checks.unique_combination(df, ["k", "s"]).isEmpty()
    assert checks.not_positive(df, "n").count() == 1


def test_relationships_count_orphans_and_ignore_null(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows(checks.relationships(child, "fk", parent, "pk")) == [(2, 2)]


def test_a_dominant_foreign_key_shuffles_as_one_row_per_task(spark):
    child = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("fk"))
    parent = spark.range(10_000, 30_000).select(F.col("id").alias("pk"))
    found = checks.relationships(child, "fk", parent, "pk")
    assert rows(found) == [(7, 10_000)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in plan


def test_failures_are_stored_and_cleared(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 3)], "k int, n int")
    path = str(tmp_path / "failures")
    tests = {"n_present": checks.not_null(df, "n"), "k_unique": checks.unique(df, "k")}
    checks.store_failures(tests, path)
    stored = spark.read.parquet(path)
    assert [(r["test_name"], r["row"]) for r in stored.collect()] == [("n_present", '{"k":1}')]
    checks.store_failures({"n_present": checks.not_null(df.where("n > 0"), "n")}, path)
    assert spark.read.parquet(f"{path}/test_name=n_present").count() == 0
    with pytest.raises(checks.TableTestError, match="n_present: 1 rows"):
        checks.require_pass(tests)
    checks.require_pass({"k_unique": checks.unique(df, "k")})


@pytest.mark.parametrize(("hours", "status"), [(25, "pass"), (27, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    df = spark.createDataFrame([(now - timedelta(hours=hours),), (None,)], "at timestamp")
    got = checks.freshness(df, "at", now).first()
    assert (got["status"], got["age_hours"]) == (status, hours)


def test_freshness_of_an_empty_table_is_an_error(spark):
    df = spark.createDataFrame([], "at timestamp")
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    assert checks.freshness(df, "at", now).first()["status"] == "error"


def test_counts_and_totals(spark):
    a, b = spark.range(3), spark.range(4)
    assert rows(reconcile.row_counts_differ(a, b, ("x", "y"))) == [(3, 4)]
    assert reconcile.row_counts_differ(a, a, ("x", "y")).isEmpty()
    fact = spark.createDataFrame([(1,), (1,), (2,)], "d int")
    mart = spark.createDataFrame([(1, 2), (3, 1)], "d int, quote_count int")
    assert sorted(map(str, reconcile.totals_differ(fact, mart, "d").collect())) == [
        "Row(d=2, fact_row_count=1, mart_quote_count=None)",
        "Row(d=3, fact_row_count=None, mart_quote_count=1)",
    ]


def test_manifest_variance(spark):
    manifest = spark.createDataFrame([(DAY, 5), (date(2024, 1, 2), 2)], "d date, source_row_count long")
    fact = spark.createDataFrame([(DAY,)] * 3 + [(date(2024, 1, 2),)] * 2, "d date")
    assert rows(reconcile.manifest_variance(manifest, fact, "d")) == [(DAY, 5, 3, 2)]


def statuses(frame):
    return {(r["subject"], str(r["as_of_date"])): r["status"] for r in frame.collect()}


def test_volume_against_median_uses_calendar_days(spark):
    start = date(2024, 1, 1)
    data = [("s", start + timedelta(days=i), 100) for i in range(7)]
    data += [("s", start + timedelta(days=7), 125), ("s", start + timedelta(days=30), 1)]
    volumes = spark.createDataFrame(data, "subject string, as_of_date date, row_count long")
    got = statuses(monitor.volume_against_median(volumes))
    assert got[("s", "2024-01-08")] == "alert"
    assert got[("s", "2024-01-07")] == "ok"
    # nothing in the seven days before: nothing to compare with
    assert got[("s", "2024-01-31")] == "ok"


def test_missing_snapshots(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "d date")
    got = monitor.missing_snapshots(df, "d", date(2024, 1, 1), date(2024, 1, 4))
    assert sorted(str(r["as_of_date"]) for r in got.collect()) == ["2024-01-02", "2024-01-04"]


def test_change_runtime_and_first_seen(spark):
    days = [DAY + timedelta(days=i) for i in range(4)]
    fares = spark.createDataFrame(
        [("E", d, v) for d, v in zip(days, (100.0, 120.0, 160.0, 0.0))], "cabin string, as_of_date date, fare double"
    )
    got = monitor.against_previous(fares, "fare", "cabin", "fare", 0.3)
    assert sorted(statuses(monitor.alerts(got))) == [("E", "2024-01-03"), ("E", "2024-01-04")]
    log = spark.createDataFrame(
        [("silver", d, datetime(2024, 1, 1), s) for d, s in zip(days, (10.0, 10.0, 25.0, 10.0))],
        "layer string, as_of_date date, logged_at timestamp, runtime_seconds double",
    )
    assert list(statuses(monitor.alerts(monitor.runtime_against_average(log)))) == [("silver", "2024-01-03")]
    reasons = spark.createDataFrame([("a", days[0]), ("b", days[2]), ("a", days[3])], "reason string, as_of_date date")
    assert statuses(monitor.first_seen(reasons)) == {("a", "2024-01-01"): "ok", ("b", "2024-01-03"): "alert"}


def test_lost_members_and_cardinality(spark):
    d1, d2, d3 = DAY, DAY + timedelta(days=1), DAY + timedelta(days=5)
    df = spark.createDataFrame([(d1, "x"), (d1, "y"), (d2, "x"), (d3, "y")], "as_of_date date, route string")
    got = statuses(monitor.lost_members(df, ["route"]))
    assert sorted(got) == [("x", "2024-01-06"), ("y", "2024-01-02")]
    counted = monitor.cardinality(df, {"route": 2})
    assert sorted(statuses(monitor.alerts(counted))) == [("route", "2024-01-02"), ("route", "2024-01-06")]


def test_skew_repeats_and_shares(spark):
    df = spark.createDataFrame([(1,)] * 8 + [(2,), (3,)], "k int")
    assert monitor.key_skew(df, ["k"]).first()["status"] == "alert"
    deliveries = spark.createDataFrame([("h", DAY), ("h", DAY), ("g", DAY)], "file_hash string, as_of_date date")
    assert [r["subject"] for r in monitor.repeated_content(deliveries).collect()] == ["h"]
    summary = spark.createDataFrame([(DAY, 2.5), (DAY, 2.5)], "as_of_date date, rejected_pct double")
    assert monitor.rejected_share(summary).first()["status"] == "alert"


def test_run_log_checks(spark):
    schema = "layer string, as_of_date date, source_row_count long, bronze_row_count long, silver_valid_count long, silver_rejected_count long, reconciled boolean"
    log = spark.createDataFrame(
        [("bronze", DAY, 10, 10, None, None, True), ("silver", DAY, None, 10, 7, 2, False)], schema
    )
    got = {r["subject"]: (r["value"], r["status"]) for r in monitor.reconciliation(log).collect()}
    assert got == {"bronze": (0.0, "ok"), "silver": (1.0, "alert")}
    delta = monitor.layer_deltas(log).first()
    assert (delta["source_to_raw"], delta["raw_to_valid"]) == (0, -3)


def test_schema_drift_verdicts(spark):
    report = spark.createDataFrame(
        [("a", "missing_columns", "int", None), ("b", "reordered_columns", "1", "c")],
        "column_name string, drift string, expected string, actual string",
    )
    assert {r["subject"]: r["status"] for r in monitor.schema_drift(report, DAY).collect()} == {"a": "alert", "b": "ok"}


def test_profiles_match_plain_counting(spark):
    data = [(i % 5, None if i % 4 == 0 else i % 3, str(i % 7)) for i in range(60)]
    df = spark.createDataFrame(data, "a int, b int, c string")
    shape = {r["column_name"]: r for r in profile.shape(df, ("a", "b", "c")).collect()}
    assert (shape["b"]["nulls"], shape["b"]["distinct_values"], shape["b"]["row_count"]) == (15, 3, 60)
    assert (shape["c"]["min_value"], shape["c"]["max_value"]) == ("0", "6")
    sizes = Counter((a, b) for a, b, _ in data)
    key = profile.candidate_keys(df, {"ab": ("a", "b")}).first()
    assert (key["distinct_keys"], key["rows_dropped"]) == (len(sizes), 60 - len(sizes))
    histogram = {r["group_size"]: r["group_count"] for r in profile.group_size_histogram(df, ("a", "b")).collect()}
    assert histogram == dict(Counter(sizes.values()))
    differing = {r["attribute"]: r["keys_that_differ"] for r in profile.differing_attributes(df, ("a",), ("b", "c")).collect()}
    assert differing == {"b": 5, "c": 5}


def test_null_beside_a_value_counts_as_a_difference(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None), (2, None), (3, 4)], "k int, v int")
    got = profile.differing_attributes(df, ("k",), ("v",)).first()
    assert (got["repeated_keys"], got["keys_that_differ"]) == (2, 1)


def test_fault_injection_keeps_all_rows(spark):
    df = spark.range(100).select("id", F.lit("F").alias("flight"), F.col("id").cast("int").alias("price"))
    out = inject_faults(df, ("id",), [Fault("negative", {"price": -1}), Fault("missing", {"price": None})])
    assert out.count() == 102
    broken = {r["fault"]: r["price"] for r in out.where("fault is not null").collect()}
    assert broken == {"negative": -1, "missing": None}
