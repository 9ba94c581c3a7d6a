"""Landings of many files, key indexes, stored parts, publications and profiles, beside what plain code says."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from test_lake import FLIGHTS, HEADER, fares, lake, write_csv  # noqa: F401

from snapstrata.operators import profile
from snapstrata.plans import build, members
from snapstrata.plans.landing import land_files
from snapstrata.plans.refine import RefinedTables, refine_snapshots
from snapstrata.sources import audit, files, tables
from snapstrata.streaming import arrivals


class Jobs:
    """Jobs that run inside a with block, by Spark's own status tracker and a job group."""

    def __init__(self, spark, name):
        self.context, self.name = spark.sparkContext, name

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.name))
        self.context.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_take_as_many_jobs_as_few(spark, lake, tmp_path):  # noqa: F811
    counts = []
    # the first landing finds no manifest, so it is not compared
    for n in (1, 2, 7):
        found = []
        for k in range(n):
            day = f"2026-{n:02d}-{k + 1:02d}"
            header = HEADER if k % 2 else HEADER[::-1]
            found.append((write_csv(tmp_path / f"a file {n} {k}.csv", fares(5 + k), header=header), day))
        with _quiet(), Jobs(spark, f"landing-{n}") as jobs:
            landed = land_files(spark, found, FLIGHTS, lake)
        assert [one.rows for one in landed] == [5 + k for k in range(n)]
        counts.append(jobs.count)
    assert counts[1] == counts[2]
    held = spark.read.parquet(lake.raw).groupBy("as_of_date", "_batch_id", "_file_hash").count()
    assert held.count() == 10 and audit.read_manifest(spark, lake.manifest).count() == 10


def _quiet():
    import warnings

    return warnings.catch_warnings(record=True)


def test_a_landing_that_failed_before_its_manifest_is_repeated(spark, lake, tmp_path, monkeypatch):  # noqa: F811
    source = write_csv(tmp_path / "f.csv", fares(8))
    other = write_csv(tmp_path / "g.csv", fares(3, offset=100))
    land_files(spark, [(other, "2026-09-09")], FLIGHTS, lake)

    def fail(*_):
        raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(audit, "record_deliveries", fail)
        with pytest.raises(InterruptedError):
            land_files(spark, [(source, "2026-09-09")], FLIGHTS, lake, merge_same_day=True)
    for _ in range(2):
        land_files(spark, [(source, "2026-09-09")], FLIGHTS, lake, merge_same_day=True)
        assert spark.read.parquet(lake.raw).count() == 11


def test_empty_deliveries_replace_and_join(spark, lake, tmp_path):  # noqa: F811
    full, none = write_csv(tmp_path / "f.csv", fares(4)), write_csv(tmp_path / "n.csv", [])
    land_files(spark, [(full, "2026-09-08"), (none, "2026-09-09"), (full, "2026-09-10"), (none, "2026-09-10")], FLIGHTS, lake)
    counts = {r[0].day: r[1] for r in spark.read.parquet(lake.raw).groupBy("as_of_date").count().collect()}
    assert counts == {8: 4}
    assert land_files(spark, [(none, "2026-09-08")], FLIGHTS, lake, merge_same_day=True)[0].taken
    assert spark.read.parquet(lake.raw).count() == 4


def test_packed_and_hidden_files(spark, tmp_path):
    import gzip

    folder = tmp_path / "in"
    folder.mkdir()
    with gzip.open(folder / "b.csv.gz", "wt", encoding="utf-8") as out:
        out.write("﻿x,y\n1,2\n")
    (folder / "_SUCCESS").write_text("")
    (folder / "a b.csv").write_text("")
    found = files.files_of(spark, str(folder))
    assert [f.path.rsplit("/", 1)[-1] for f in found] == ["a b.csv", "b.csv.gz"]
    assert [files.first_line_of(spark, f.path) for f in found] == ["", "x,y"]
    places = {r[0] for r in spark.read.text([f.path for f in found]).select(files.located()).distinct().collect()}
    assert places == {found[1].place}


def test_a_delivery_that_lands_during_a_refining_stays_to_be_refined(spark, lake, tmp_path):  # noqa: F811
    first, second = write_csv(tmp_path / "1.csv", fares(6)), write_csv(tmp_path / "2.csv", fares(9))
    land_files(spark, [(first, "2026-09-09")], FLIGHTS, lake)
    refine_snapshots(
        spark, lake.raw, lake.refined, lake.run_log, FLIGHTS, manifest_path=lake.manifest,
        after_write=lambda: land_files(spark, [(second, "2026-09-09")], FLIGHTS, lake),
    )
    assert RefinedTables(lake.refined).read_valid(spark).count() == 6
    assert build.unrefined(spark, lake) == [date(2026, 9, 9)]
    assert not build.take_in(spark, second, FLIGHTS, lake, as_of_date="2026-09-09").taken
    assert build.unrefined(spark, lake) == [] and RefinedTables(lake.refined).read_valid(spark).count() == 9


def test_a_key_index_reads_touched_buckets_and_snapshots_only(spark, tmp_path):
    target = str(tmp_path / "t")

    def send(rows, name):
        source = str(tmp_path / name)
        spark.createDataFrame(rows, "id long, at int, day date").write.parquet(source)
        stream = spark.readStream.schema("id long, at int, day date").parquet(source)
        arrivals.merge_arrivals(stream, target, source + "-ck", key=("id",), tiebreak=(("at", "desc"),), snapshot="day", index_buckets=4)

    def held():
        return {(r.id, r.at, r.day and r.day.day) for r in spark.read.schema("id long, at int, day date").parquet(target).collect()}

    days = [date(2024, 1, d) for d in range(1, 6)]
    send([(k, 1, days[k % 5]) for k in range(20)], "a")
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-05").glob("*.parquet")}
    send([(0, 2, days[2]), (1, 2, None), (2, 0, days[3]), (99, 1, days[0])], "b")
    want = {(k, 1, k % 5 + 1) for k in range(3, 20)} | {(0, 2, 3), (1, 2, None), (2, 1, 3), (99, 1, 1)}
    assert held() == want
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-05").glob("*.parquet")}
    send([(0, 3, days[1]), (1, 3, days[1])], "c")
    assert held() == (want - {(0, 2, 3), (1, 2, None)}) | {(0, 3, 2), (1, 3, 2)}
    index = spark.read.parquet(target + "_keys").where("id IN (0, 1, 5)").collect()
    assert {(r.id, r.day.day) for r in index if r.id == 5} == {(5, 1)}
    # a table without an index gets one from its keys
    import shutil

    shutil.copytree(target, str(tmp_path / "old"))
    target = str(tmp_path / "old")
    send([(0, 4, days[4])], "d")
    assert (0, 4, 5) in held() and sum(k == 0 for k, _, _ in held()) == 1


def test_bitmaps_count_what_sets_count(spark, tmp_path):
    rows = [(f"g{k % 3}", None if k % 11 == 0 else f"v{k * 7 % 40}", k % 4) for k in range(300)]
    frame = spark.createDataFrame(rows, "g string, v string, part int").repartition(3)
    path, kept = str(tmp_path / "numbers"), str(tmp_path / "bits")
    for part in range(4):
        own = frame.where(F.col("part") == part)
        numbers = members.number_values(spark, path, own, ("v",))
        members.member_bitmaps(own, ("part", "g"), "v", numbers).write.mode("append").parquet(kept)
    bits = spark.read.parquet(kept)
    got = {r.g: r.n for r in members.distinct_counts(bits, ("g",), n="v").collect()}
    assert got == {g: len({v for h, v, _ in rows if h == g and v is not None}) for g in ("g0", "g1", "g2")}
    every = spark.read.parquet(path).collect()
    assert len({r.value for r in every}) == len({r.number for r in every}) == len(every)


def test_shape_of_all_kinds_of_columns(spark):
    rows = [
        (1, 2.5, Decimal("1.20"), "b", date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), True, 7.0),
        (None, float("nan"), None, "a", None, None, False, None),
        (-3, -0.0, Decimal("-5.00"), "a", date(1969, 5, 6), datetime(1969, 1, 1), None, 7.0),
        (1, 0.0, Decimal("1.20"), None, date(2024, 1, 2), None, True, 7.0),
    ]
    schema = "i int, d double, m decimal(9,2), s string, day date, at timestamp, b boolean, f float"
    frame = spark.createDataFrame(rows, schema)
    shape = profile.shape(frame, frame.columns)
    got = {r.column_name: tuple(r)[1:] for r in shape.collect()}
    for c in frame.columns:
        n, nulls, distinct, low, high = frame.agg(
            F.count("*"), F.count_if(F.col(c).isNull()), F.count_distinct(c), F.min(c).cast("string"), F.max(c).cast("string")
        ).first()
        assert got[c][:3] == (n, nulls, distinct) and got[c][4] == high and got[c][3].lstrip("-") == low.lstrip("-"), c
    assert shape._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2
    empty = profile.shape(frame.limit(0), ["i", "s"]).collect()
    assert [tuple(r) for r in empty] == [("i", 0, 0, 0, None, None), ("s", 0, 0, 0, None, None)]


def test_minimal_keys_equal_brute_force(spark):
    names = ["a", "b", "c", "d"]
    rows = [(k % 3, k // 3 % 4, None if k % 5 == 0 else k % 5, k % 2) for k in range(24)]
    frame = spark.createDataFrame(rows, "a int, b int, c int, d int")
    want: list = []
    for size in range(1, 5):
        for pick in combinations(range(4), size):
            if len({tuple(r[k] for k in pick) for r in rows}) == len(rows) and not any(set(w) <= set(pick) for w in want):
                want.append(pick)
    got = {r.key_columns for r in profile.minimal_keys(frame, names).collect()}
    assert got == {",".join(names[k] for k in w) for w in want} and got
    assert profile.minimal_keys(frame.unionAll(frame), names).collect() == []
    assert profile.minimal_keys(frame, names, most=1).collect() == []


def test_minimal_keys_look_at_all_rows_only_where_a_share_disproves_nothing(spark, monkeypatch):
    seen = []
    real = profile._repeating
    monkeypatch.setattr(profile, "_repeating", lambda rows, chosen, slices: seen.append((slices, len(chosen))) or real(rows, chosen, slices))
    frame = spark.range(0, 6000).selectExpr("id % 2000 AS a", "id div 2000 * 1000 + id % 1000 AS b", "id % 1000 AS c", "id % 500 AS d")
    assert {r.key_columns for r in profile.minimal_keys(frame, frame.columns).collect()} == {"a,b"}
    # all columns together, and the key
    assert sum(n for slices, n in seen if slices == 1) == 2


def test_minimal_keys_of_no_rows_and_of_nulls_that_change_places(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert [r.key_columns for r in profile.minimal_keys(empty, ["a", "b"]).collect()] == ["a", "b"]
    swapped = spark.createDataFrame([(None, 1), (1, None), (1, 1), (None, None)], "a int, b int")
    assert [r.key_columns for r in profile.minimal_keys(swapped, ["a", "b"]).collect()] == ["a,b"]


def test_publication_switches_partitions_and_keeps_rows_without_a_date(spark, tmp_path):
    name, root = f"pub_{tmp_path.name.replace('-', '_')}", str(tmp_path / "p")
    first = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "k int, day date")
    assert tables.publish_snapshots(spark, name, first, root, "day") == [date(2024, 1, 1), date(2024, 1, 2), None]
    tables.publish_snapshots(spark, name, spark.createDataFrame([(4, date(2024, 1, 2)), (5, None)], "k int, day date"), root, "day")
    assert sorted((r.k, str(r.day)) for r in spark.table(name).collect()) == [(1, "2024-01-01"), (4, "2024-01-02"), (5, "None")]


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 6).selectExpr("id % 3 AS day", "CASE WHEN id % 3 = 0 THEN 500 ELSE pmod(xxhash64(id), 1000) END AS part", "id")
    plain, apart = str(tmp_path / "plain"), str(tmp_path / "apart")
    tables.write_partitions(rows, plain, by=("day",), sort=("part",))
    tables.write_partitions(rows, apart, by=("day",), cluster=("part",), files=30)

    def files_left(path, low, high):
        held = spark.read.parquet(path).where("day > 0").groupBy(F.col("_metadata.file_path").alias("f"))
        ends = held.agg(F.min("part").alias("lo"), F.max("part").alias("hi")).collect()
        return sum(r["lo"] <= high and r["hi"] >= low for r in ends), len(ends)

    left, every = files_left(apart, 300, 320)
    assert every >= 16 and left <= 6 and files_left(plain, 300, 320)[0] == files_left(plain, 300, 320)[1]
    # the value that holds a third of all rows is cut
    hot = spark.read.parquet(apart).where("day = 0").groupBy("_metadata.file_path").count().collect()
    assert len(hot) >= 6 and max(r["count"] for r in hot) < 6_000
    assert sorted(r.id for r in spark.read.parquet(apart).select("id").collect()) == list(range(60_000))


def test_hot_keys_equal_plain_counts(spark):
    from snapstrata.operators import monitor

    rows = spark.range(0, 30_000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 50 = 1 THEN 7 ELSE id END AS k", "id % 4 AS j")
    for share, of in ((1, 100), (1, 4), (1, 20_000)):
        got = {(r.key_column, r.key_value, r.row_count) for r in monitor.hot_keys(rows, ("k", "j"), share, of).collect()}
        want = set()
        for key in ("k", "j"):
            counts = rows.groupBy(key).count().collect()
            want |= {(key, None if r[0] is None else str(r[0]), r[1]) for r in counts if r[1] * of >= 30_000 * share}
        assert got == want


def test_stored_statistics_decide_a_plan(spark, tmp_path):
    from snapstrata.sources import scan

    name = f"stat_{tmp_path.name.replace('-', '_')}"
    rows = spark.range(0, 200_000, 1, 4).selectExpr("id", "id % 1000 AS part", "sha2(string(id), 256) AS payload")
    rows.write.format("parquet").option("path", str(tmp_path / "t")).saveAsTable(name)
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "200k", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)

    def plan():
        small = spark.table(name).where("part = 5").select("id", "part")
        joined = spark.table(name).join(small.withColumnRenamed("part", "p"), "id")
        return joined._jdf.queryExecution().executedPlan().toString()

    try:
        assert "SortMergeJoin" in plan()
        scan.refresh_statistics(spark, name, columns=("id", "part"))
        assert "BroadcastHashJoin" in plan()
        got = scan.column_statistics(spark, name, ("id", "part")).collect()
        assert [tuple(r) for r in got] == [("id", 200_000, 0, "0", "199999"), ("part", 200_000, 0, "0", "999")]
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
