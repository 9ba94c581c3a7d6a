"""From delivered text files to gold tables, with reruns, repeats and faults."""

from __future__ import annotations

import csv
import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapstrata.contracts.flights import (
    AIRLINES,
    CABINS,
    CITIES,
    DAY_PARTS,
    FARE_COLUMNS,
    FLIGHTS,
    STAGED_QUOTE,
    STAGED_REJECT,
)
from snapstrata.operators import checks, reconcile
from snapstrata.operators.faults import faults_of
from snapstrata.plans import build
from snapstrata.plans.landing import Lake, land_file
from snapstrata.plans.refine import EmptyInputError, RefinedTables, refine_snapshots
from snapstrata.sources import audit, drift, fingerprint, scan
from snapstrata.streaming import arrivals

HEADER = [n for n, _ in FARE_COLUMNS]
FAULTS = faults_of(FLIGHTS.rules)


def fares(n, offset=0):
    """Clean rows that differ in their business key."""
    rows = []
    for i in range(offset, offset + n):
        origin = CITIES[i % 6]
        rows.append(
            {
                "index": str(i),
                "airline": AIRLINES[(i // 6) % 6],
                "flight": f"XX-{i % 50}",
                "source_city": origin,
                "departure_time": DAY_PARTS[i % 6],
                "stops": ("zero", "one", "two_or_more")[i % 3],
                "arrival_time": DAY_PARTS[(i + 2) % 6],
                "destination_city": CITIES[(i + 1 + i % 4) % 6],
                "class": CABINS[(i // 3) % 2],
                "duration": f"{1 + (i % 40) / 4:.2f}",
                "days_left": str(1 + i % 49),
                "price": str(1000 + i * 7),
            }
        )
    return rows


def write_csv(path, rows, header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, header, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def log_of(spark, lake, layer):
    return audit.read_run_log(spark, lake.run_log).where(F.col("layer") == layer)


def test_clean_file(spark, lake, tmp_path):
    source = write_csv(tmp_path / "day1.csv", fares(400))
    landed = build.take_in(spark, source, FLIGHTS, lake, as_of_date="2026-09-09")
    assert landed.taken and landed.rows == 400
    split = RefinedTables(lake.refined)
    assert split.read_valid(spark).count() == 400
    assert split.read_rejected(spark).count() == 0
    assert set(split.read_valid(spark).columns) == set(FLIGHTS.output)
    bronze = log_of(spark, lake, "bronze").first()
    assert (bronze["source_row_count"], bronze["bronze_row_count"], bronze["reconciled"]) == (400, 400, True)
    silver = log_of(spark, lake, "silver").first()
    assert (silver["silver_valid_count"], silver["silver_rejected_count"]) == (400, 0)
    assert silver["rejection_reason_breakdown"] == "{}"


def test_a_file_with_every_fault(spark, lake, tmp_path):
    good = fares(300)
    bad = []
    for k, fault in enumerate(FAULTS):
        values = {name: "" if value is None else str(value) for name, value in fault.values.items()}
        bad.append({**good[k], "index": str(9000 + k), "flight": f"broken-{k}", "stops": "one", **values})
    source = write_csv(tmp_path / "faulty.csv", good + bad)
    build.take_in(spark, source, FLIGHTS, lake, as_of_date="2026-09-10")
    log = log_of(spark, lake, "silver").first()
    assert (log["bronze_row_count"], log["silver_valid_count"]) == (300 + len(FAULTS), 300)
    assert log["silver_rejected_count"] == len(FAULTS) and log["reconciled"]
    breakdown = json.loads(log["rejection_reason_breakdown"])
    assert set(",".join(breakdown).split(",")) >= {f.reason for f in FAULTS} - {"null_airline"}
    assert sum(breakdown.values()) == len(FAULTS)
    rejected = RefinedTables(lake.refined).read_rejected(spark)
    assert rejected.where(~F.col("flight").startswith("BROKEN-")).isEmpty()


def test_same_content_is_taken_in_once_even_renamed(spark, lake, tmp_path):
    rows = fares(50)
    first = write_csv(tmp_path / "a.csv", rows)
    again = write_csv(tmp_path / "renamed.csv", rows)
    assert build.take_in(spark, first, FLIGHTS, lake, as_of_date="2026-09-09").taken
    assert not build.take_in(spark, again, FLIGHTS, lake, as_of_date="2026-09-09").taken
    assert build.take_in(spark, again, FLIGHTS, lake, as_of_date="2026-09-10").taken
    assert build.take_in(spark, again, FLIGHTS, lake, as_of_date="2026-09-09", force=True).taken
    assert spark.read.parquet(lake.raw).groupBy("as_of_date").count().where("count <> 50").isEmpty()


def test_rerun_that_fixes_the_data_clears_old_rejects(spark, lake, tmp_path):
    rows = fares(20)
    broken = write_csv(tmp_path / "broken.csv", [{**r, "price": "0"} for r in rows])
    fixed = write_csv(tmp_path / "fixed.csv", rows)
    build.take_in(spark, broken, FLIGHTS, lake, as_of_date="2026-09-09")
    split = RefinedTables(lake.refined)
    assert (split.read_valid(spark).count(), split.read_rejected(spark).count()) == (0, 20)
    build.take_in(spark, fixed, FLIGHTS, lake, as_of_date="2026-09-09")
    assert (split.read_valid(spark).count(), split.read_rejected(spark).count()) == (20, 0)


def test_second_file_of_a_day_can_join_the_first(spark, lake, tmp_path):
    one = write_csv(tmp_path / "one.csv", fares(30))
    two = write_csv(tmp_path / "two.csv", fares(30, offset=20))
    land_file(spark, one, FLIGHTS, lake, as_of_date="2026-09-09", merge_same_day=True)
    land_file(spark, two, FLIGHTS, lake, as_of_date="2026-09-09", merge_same_day=True)
    assert spark.read.parquet(lake.raw).count() == 60
    refine_snapshots(spark, lake.raw, lake.refined, lake.run_log, FLIGHTS)
    split = RefinedTables(lake.refined)
    assert split.read_valid(spark).count() == 50
    assert split.read_rejected(spark).select("rejection_reason").distinct().collect() == [
        ("duplicate_business_key",)
    ]


def test_nothing_to_refine_is_an_error(spark, lake, tmp_path):
    source = write_csv(tmp_path / "a.csv", fares(5))
    land_file(spark, source, FLIGHTS, lake, as_of_date="2026-09-09")
    with pytest.raises(EmptyInputError):
        refine_snapshots(
            spark, lake.raw, lake.refined, lake.run_log, FLIGHTS, snapshots=["2030-01-01"]
        )


def test_reordered_header_is_read_by_name(spark, lake, tmp_path):
    shuffled = write_csv(tmp_path / "r.csv", fares(10), header=HEADER[::-1])
    straight = write_csv(tmp_path / "s.csv", fares(10))
    with pytest.warns(UserWarning, match="order"):
        a = scan.scan_csv(spark, shuffled, FLIGHTS).drop("_source_file").collect()
    b = scan.scan_csv(spark, straight, FLIGHTS).drop("_source_file").collect()
    assert sorted(a) == sorted(b)
    with pytest.raises(drift.SchemaDriftError):
        scan.scan_csv(spark, shuffled, FLIGHTS, allow_reorder=False)


def test_unparsable_line_keeps_its_text(spark, tmp_path):
    rows = fares(2)
    rows[1]["price"] = "expensive"
    source = write_csv(tmp_path / "m.csv", rows)
    bad = scan.scan_csv(spark, source, FLIGHTS).where("_corrupt_record is not null").first()
    assert bad["price"] is None and "expensive" in bad["_corrupt_record"]
    assert bad["airline"] == rows[1]["airline"]


def changes_of(names):
    texts = lambda columns: [(n, "string") for n in columns]
    return {(c.column_name, c.drift) for c in drift.column_changes(texts(names), texts(HEADER))}


def test_every_single_change_of_a_header_is_named():
    assert changes_of(HEADER) == set()
    for k, name in enumerate(HEADER):
        rest = HEADER[:k] + HEADER[k + 1 :]
        assert changes_of(rest) == {(name, drift.MISSING)}
        assert changes_of([*rest, f"{name}_2"]) == {(name, drift.MISSING), (f"{name}_2", drift.UNEXPECTED)}
        assert changes_of([*HEADER, name]) == {(name, drift.UNEXPECTED)}
        if k:
            assert changes_of([*HEADER[: k - 1], name, HEADER[k - 1], *HEADER[k + 1 :]]) == {
                (name, drift.REORDERED), (HEADER[k - 1], drift.REORDERED)
            }


def test_the_gate_lets_an_order_pass_only_where_allowed():
    with pytest.warns(UserWarning, match="another order"):
        drift.gate_header(HEADER[::-1], FLIGHTS.source_schema)
    with pytest.raises(drift.SchemaDriftError):
        drift.gate_header(HEADER[::-1], FLIGHTS.source_schema, allow_reorder=False)


def test_structural_drift_stops_the_run_before_anything_is_written(spark, lake, tmp_path):
    source = write_csv(tmp_path / "d.csv", fares(3), header=["airline", "flight", "price"])
    with pytest.raises(drift.SchemaDriftError, match="missing_columns"):
        build.take_in(spark, source, FLIGHTS, lake, as_of_date="2026-09-09")
    assert not (tmp_path / "lake").exists()


def test_drift_report(spark):
    from pyspark.sql.types import StructType

    actual = StructType.fromDDL("a int, b string, x int")
    expected = StructType.fromDDL("a long, b string, c date")
    rows = {(r["column_name"], r["drift"]) for r in drift.drift_report(spark, actual, expected).collect()}
    assert rows == {("a", "retyped_columns"), ("x", "unexpected_columns"), ("c", "missing_columns")}


def test_header_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_text('\ufeffa,"b,c" , d\n1,2,3\n', encoding="utf-8")
    assert drift.header_of(spark, str(path)) == ["a", "b,c", "d"]


def test_fingerprint_depends_on_content_only(spark, tmp_path):
    rows = fares(40)
    one = write_csv(tmp_path / "one.csv", rows)
    moved = write_csv(tmp_path / "moved.csv", rows[::-1])
    twice = write_csv(tmp_path / "twice.csv", [*rows, rows[0]])
    a, n, files = fingerprint.file_fingerprint(spark, one)
    assert (n, files) == (40, 1)
    assert fingerprint.file_fingerprint(spark, moved)[0] == a
    assert fingerprint.file_fingerprint(spark, twice)[0] != a
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    assert fingerprint.file_fingerprint(spark, str(empty))[1] == 0


def test_fingerprint_does_not_depend_on_the_split(spark, tmp_path):
    rows = fares(30)
    whole = fingerprint.file_fingerprint(spark, write_csv(tmp_path / "one.csv", rows))
    parts = tmp_path / "parts"
    parts.mkdir()
    for k in range(3):
        write_csv(parts / f"p{k}.csv", rows[k * 10 : k * 10 + 10])
    assert fingerprint.file_fingerprint(spark, str(parts)) == (whole[0], 30, 3)


def test_a_padded_header_is_the_same_delivery(spark, lake, tmp_path):
    rows = fares(12)
    plain = write_csv(tmp_path / "plain.csv", rows)
    assert build.take_in(spark, plain, FLIGHTS, lake, as_of_date="2026-09-09").rows == 12
    padded = tmp_path / "padded.csv"
    first, rest = Path(plain).read_text().split("\n", 1)
    padded.write_text("\ufeff" + first.replace(",", " , ") + "\n" + rest, encoding="utf-8")
    again = build.take_in(spark, str(padded), FLIGHTS, lake, as_of_date="2026-09-09")
    assert not again.taken
    other = build.take_in(spark, str(padded), FLIGHTS, lake, as_of_date="2026-09-10")
    assert other.rows == 12 and spark.read.parquet(lake.raw).where("price is null").count() == 0


def test_a_failed_refining_is_made_up_for(spark, lake, tmp_path):
    from snapstrata.plans.landing import land_file
    from snapstrata.plans.refine import RefinedTables

    source = write_csv(tmp_path / "f.csv", fares(9))
    land_file(spark, source, FLIGHTS, lake, as_of_date="2026-09-09")
    assert build.unrefined(spark, lake) == [date(2026, 9, 9)]
    assert not build.take_in(spark, source, FLIGHTS, lake, as_of_date="2026-09-09").taken
    assert build.unrefined(spark, lake) == []
    assert RefinedTables(lake.refined).read_valid(spark).count() == 9


def test_gold_follows_a_snapshot_that_is_refined_again_or_emptied(spark, lake, tmp_path):
    from snapstrata.contracts.flights import STAGED_QUOTE, STAGED_REJECT, fare_rules
    from snapstrata.plans.refine import refine_snapshots

    def refresh():
        return build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT, ungated=("premium_is_sane",))

    def fact():
        return spark.read.parquet(f"{lake.gold}/fct_flight_price_quote").groupBy("as_of_date").count().collect()

    rows = fares(10)
    for day in (9, 10):
        build.take_in(spark, write_csv(tmp_path / f"{day}.csv", rows), FLIGHTS, lake, as_of_date=f"2026-09-{day:02d}")
    assert [d.day for d in refresh()] == [9, 10] and refresh() == []
    middle = sorted(r["price"] for r in rows)[5]
    strict = FLIGHTS.with_options(rules=fare_rules(price=(1, middle)))
    refine_snapshots(spark, lake.raw, lake.refined, lake.run_log, strict, snapshots=["2026-09-10"])
    assert [d.day for d in refresh()] == [10]
    left = sum(r["price"] <= middle for r in rows)
    assert {r["as_of_date"].day: r["count"] for r in fact()} == {9: 10, 10: left} and left < 10
    header = write_csv(tmp_path / "none.csv", [])
    build.take_in(spark, header, FLIGHTS, lake, as_of_date="2026-09-09")
    assert [d.day for d in refresh()] == [9]
    assert {r["as_of_date"].day: r["count"] for r in fact()} == {10: left}
    quality = spark.read.parquet(f"{lake.gold}/mart_data_quality_summary").where("as_of_date = '2026-09-09'")
    assert quality.count() == 0


def test_a_failing_test_stops_the_load(spark, lake, tmp_path):
    from snapstrata.contracts.flights import fare_rules

    build.take_in(spark, write_csv(tmp_path / "f.csv", fares(10)), FLIGHTS, lake, as_of_date="2026-09-09")
    narrow = FLIGHTS.with_options(rules=fare_rules(airlines=AIRLINES[:1]))
    with pytest.raises(checks.TableTestError, match="accepted_airline_name"):
        build.refresh_gold(spark, lake, narrow, STAGED_QUOTE, STAGED_REJECT)
    assert not Path(lake.gold).exists()
    assert [d.day for d in build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT, ungated=("premium_is_sane",))] == [9]


def test_snapshot_resolution(spark, tmp_path, monkeypatch):
    source = write_csv(tmp_path / "s.csv", fares(1))
    assert scan.resolve_snapshot(spark, source, "2024-05-06") == date(2024, 5, 6)
    monkeypatch.setenv("AS_OF_DATE", "2024-07-08")
    assert scan.resolve_snapshot(spark, source) == date(2024, 7, 8)
    monkeypatch.delenv("AS_OF_DATE")
    assert isinstance(scan.resolve_snapshot(spark, source), date)
    assert scan.new_batch_id(date(2024, 1, 1)) != scan.new_batch_id(date(2024, 1, 1))


def gold(spark, lake):
    names = (
        "fct_flight_price_quote dim_airline dim_route dim_lead_time_bucket mart_route_performance "
        "mart_booking_leadtime_pricing mart_airline_cabin_mix mart_data_quality_summary"
    ).split()
    return {n: spark.read.parquet(f"{lake.gold}/{n}") for n in names}


def test_gold_refresh_over_two_days(spark, lake, tmp_path):
    day1 = write_csv(tmp_path / "d1.csv", fares(300))
    day2 = write_csv(tmp_path / "d2.csv", [*fares(200, offset=50), {**fares(1)[0], "price": "0"}])
    build.take_in(spark, day1, FLIGHTS, lake, as_of_date="2026-09-09")
    assert build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT) == [date(2026, 9, 9)]
    build.take_in(spark, day2, FLIGHTS, lake, as_of_date="2026-09-10")
    build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT)
    tables = gold(spark, lake)
    fact = tables["fct_flight_price_quote"]
    assert {str(r[0]): r[1] for r in fact.groupBy("as_of_date").count().collect()} == {
        "2026-09-09": 300,
        "2026-09-10": 200,
    }
    quality = {
        (str(r["as_of_date"]), r["rejection_reason"]): r["rejected_row_count_for_reason"]
        for r in tables["mart_data_quality_summary"].collect()
    }
    assert quality == {("2026-09-09", "n/a"): 0, ("2026-09-10", "price_out_of_range"): 1}
    tests = checks.gold_tests(tables, AIRLINES, CABINS)
    failed = {r["test_name"] for r in checks.failure_counts(tests).where("failures > 0").collect()}
    # invented fares need not be dearer in business class; everything else must hold
    assert failed <= {"premium_is_sane"}
    assert reconcile.totals_differ(fact, tables["mart_route_performance"], "as_of_date").isEmpty()
    # a full refresh gives the same tables as the incremental runs
    before = {n: sorted(map(str, t.collect())) for n, t in tables.items()}
    build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT, full_refresh=True)
    spark.catalog.clearCache()
    assert {n: sorted(map(str, t.collect())) for n, t in gold(spark, lake).items()} == before


def test_late_file_for_an_old_day_is_picked_up_and_others_stay(spark, lake, tmp_path):
    days = [date(2026, 9, 8), date(2026, 9, 9)]
    for number, day in enumerate(days):
        source = write_csv(tmp_path / f"{day}.csv", fares(60, offset=number))
        build.take_in(spark, source, FLIGHTS, lake, as_of_date=day)

    def refresh(**options):
        return build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT, **options)

    assert refresh() == days
    assert refresh() == []
    late = write_csv(tmp_path / "late.csv", fares(25))
    build.take_in(spark, late, FLIGHTS, lake, as_of_date="2026-09-08")
    assert refresh() == days[:1]
    counts = gold(spark, lake)["fct_flight_price_quote"].groupBy("as_of_date").count().collect()
    assert sorted(tuple(r) for r in counts) == [(days[0], 25), (days[1], 60)]
    assert refresh(snapshots=["2026-09-09"]) == days[1:]


def test_fully_rejected_day_shows_in_the_quality_mart(spark, lake, tmp_path):
    good = write_csv(tmp_path / "good.csv", fares(12))
    bad = write_csv(tmp_path / "bad.csv", [{**r, "price": "0"} for r in fares(12)])
    build.take_in(spark, good, FLIGHTS, lake, as_of_date="2026-09-08")
    build.take_in(spark, bad, FLIGHTS, lake, as_of_date="2026-09-09")
    build.refresh_gold(spark, lake, FLIGHTS, STAGED_QUOTE, STAGED_REJECT)
    rows = gold(spark, lake)["mart_data_quality_summary"].collect()
    assert {str(r["as_of_date"]): r["rejected_pct"] for r in rows} == {
        "2026-09-08": 0.0,
        "2026-09-09": 100.0,
    }


def test_inbox_stream_takes_each_file_once(spark, lake, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write_csv(inbox / "2026-09-08.csv", fares(10))
    write_csv(inbox / "2026-09-09.csv", fares(20))

    def snapshot_of(path):
        return path.rsplit("/", 1)[-1].removesuffix(".csv")

    def run():
        arrivals.take_in_arrivals(
            spark, str(inbox), FLIGHTS, lake, str(tmp_path / "seen"), snapshot_of
        )
        return RefinedTables(lake.refined).read_valid(spark).count()

    assert run() == 30
    assert run() == 30
    write_csv(inbox / "2026-09-10.csv", fares(5))
    assert run() == 35
    assert audit.read_manifest(spark, lake.manifest).count() == 3


def test_stream_duplicate_guard(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:05", 1), ("2024-01-01 00:00:07", 2)]
    source = tmp_path / "events"
    spark.createDataFrame(rows, "at string, id int").select(
        F.col("at").cast("timestamp").alias("at"), "id"
    ).write.parquet(str(source))
    stream = spark.readStream.schema("at timestamp, id int").parquet(str(source))
    once = arrivals.drop_repeats(stream, "at", ("id",), "1 hour")
    target = str(tmp_path / "out")

    def handle(batch, _):
        batch.write.mode("append").parquet(target)

    arrivals.run_available(once, handle, str(tmp_path / "ck"))
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2]
