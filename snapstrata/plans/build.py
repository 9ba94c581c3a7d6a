"""From a delivered file to refreshed gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.contract import SnapshotContract
from snapstrata.functions.rules import OneOf
from snapstrata.operators import checks
from snapstrata.operators.merge import in_snapshots, partition_values
from snapstrata.plans import marts, star
from snapstrata.plans.landing import Lake, Landed, land_files
from snapstrata.plans.refine import RefinedTables, as_dates, refine_snapshots
from snapstrata.sources import audit, tables


def unrefined(spark: SparkSession, lake: Lake) -> list[date | None]:
    """Snapshots with a delivery that no reconciled refining run has read."""
    known = audit.deliveries(audit.read_manifest(spark, lake.manifest))
    return audit.in_order(audit.by_snapshot(audit.not_consumed(known, audit.read_run_log(spark, lake.run_log), "silver")))


def take_in(
    spark: SparkSession,
    path: str,
    contract: SnapshotContract,
    lake: Lake,
    *,
    as_of_date: str | date | None = None,
    force: bool = False,
    merge_same_day: bool = False,
) -> Landed:
    """Land one file and refine the snapshot it belongs to.

    A repeat lands nothing.  Whether to refine is decided by the control tables, not by
    this landing: a run that failed between the two is made up for by the next.
    """
    (landed,) = take_in_all(spark, [(path, as_of_date)], contract, lake, force=force, merge_same_day=merge_same_day)
    return landed


def take_in_all(
    spark: SparkSession,
    deliveries: Sequence[tuple[str, str | date | None]],
    contract: SnapshotContract,
    lake: Lake,
    *,
    force: bool = False,
    merge_same_day: bool = False,
) -> list[Landed]:
    """``take_in`` for several deliveries, given as (path, snapshot date): one landing, one refining for all snapshots."""
    landed = land_files(spark, deliveries, contract, lake, force=force, merge_same_day=merge_same_day)
    waiting = set(unrefined(spark, lake))
    days = audit.in_order([one.as_of_date for one in landed if one.as_of_date in waiting])
    if days:
        refine_snapshots(
            spark,
            lake.raw,
            lake.refined,
            lake.run_log,
            contract,
            snapshots=days,
            batch_id=landed[0].batch_id if len(landed) == 1 else None,
            manifest_path=lake.manifest,
        )
    return landed


def gold_frames(
    spark: SparkSession,
    valid: DataFrame,
    rejected: DataFrame,
    contract: SnapshotContract,
    staged_quote: Sequence[tuple[str, str, str | None]],
    staged_reject: Sequence[tuple[str, str, str | None]],
) -> dict[str, DataFrame]:
    """Every gold table as a DataFrame, keyed by name."""
    staged = star.stage(valid, staged_quote)
    turned_away = star.stage(rejected, staged_reject)
    fact = star.fact_quotes(star.enrich(staged, contract.bands))
    cube = star.fare_cube(fact)
    return {
        "stg_flights": staged,
        "stg_flights_rejected": turned_away,
        "fct_flight_price_quote": fact,
        "dim_airline": star.dim_carrier(cube),
        "dim_route": star.dim_route(cube),
        "dim_lead_time_bucket": star.dim_lead_time_band(spark, contract.bands),
        "mart_route_performance": marts.route_performance(cube),
        "mart_booking_leadtime_pricing": marts.lead_time_pricing(fact),
        "mart_airline_cabin_mix": marts.carrier_cabin_mix(cube),
        "mart_data_quality_summary": marts.data_quality_summary(
            marts.reason_table(staged, turned_away)
        ),
    }


def unrefreshed_runs(spark: SparkSession, lake: Lake) -> dict[date | None, list[str]]:
    """Per snapshot the refining runs that no refresh of the gold tables has read."""
    log = audit.read_run_log(spark, lake.run_log)
    return audit.by_snapshot(audit.not_consumed(audit.finished_runs(log, "silver"), log, "gold"))


def changed_snapshots(spark: SparkSession, lake: Lake, runs: Mapping[date | None, Sequence[str]] | None = None) -> list[date | None]:
    """Snapshots with a refining run that no refresh has read (``runs``), or that were never refreshed.

    Found in the run log, which has a row per snapshot and run, and in the names of the
    refined partitions; no row of the history is read.  A refining run counts
    whatever it changed: new rules, corrected rejects, or a snapshot that lost all its rows.
    """
    runs = unrefreshed_runs(spark, lake) if runs is None else runs
    refreshed = audit.read_run_log(spark, lake.run_log).where((F.col("layer") == "gold") & F.col("reconciled"))
    known = set(partition_values(refreshed, "as_of_date"))
    return audit.in_order([*runs, *(RefinedTables(lake.refined).snapshots(spark, "as_of_date") - known)])


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    contract: SnapshotContract,
    staged_quote: Sequence[tuple[str, str, str | None]],
    staged_reject: Sequence[tuple[str, str, str | None]],
    *,
    snapshots: Sequence[str | date | None] | None = None,
    full_refresh: bool = False,
    ungated: Sequence[str] = (),
    after_write: Callable[[], None] | None = None,
) -> list[date | None]:
    """Bring the gold tables up to date with the refined layer.

    Takes the named snapshots, or those that changed since the last refresh
    (``changed_snapshots``, which also finds late files for old days and snapshots that
    were emptied), or all of them on a full refresh.  Fact, rollup and marts carry the snapshot in their
    grain, so only the touched snapshots are recomputed and replaced; the
    dimensions span all snapshots and are folded from the stored rollup.
    The staging views are registered, not stored.  Returns the touched snapshots.

    Tests gate the load, as they do in a build of models: those on the refined
    rows of the touched snapshots run before anything is written, those on the
    gold tables before the refresh is entered in the run log.  A refresh that fails
    raises, and is taken up again by the next.  ``ungated`` names tests that do not
    stop a load.  Refined rows without a snapshot are a snapshot of their own, None, and stop the load by
    ``not_null_as_of_date`` unless that test is ungated.

    The log entry names the refining runs that were known before the first row was read.  A
    refining run that ends while the refresh is under way is not among them, so the next
    refresh takes it up.  ``after_write`` is called between the writes and the tests of the gold tables.
    """
    runs = unrefreshed_runs(spark, lake)
    refined = RefinedTables(lake.refined)
    valid, rejected = refined.read_valid(spark), refined.read_rejected(spark)
    staged, turned_away = star.stage(valid, staged_quote), star.stage(rejected, staged_reject)
    staged.createOrReplaceTempView("stg_flights")
    turned_away.createOrReplaceTempView("stg_flights_rejected")

    fact_path, cube_path = f"{lake.gold}/fct_flight_price_quote", f"{lake.gold}/fare_cube"
    if snapshots is not None:
        days = audit.in_order(as_dates(snapshots))
    else:
        days = changed_snapshots(spark, lake, runs)
        if full_refresh:
            known = (*partition_values(staged, "as_of_date"), *partition_values(turned_away, "as_of_date"))
            days = audit.in_order([*days, *tables.partition_dates(spark, fact_path, "as_of_date"), *known])
    if not days:
        return []
    touched = in_snapshots("as_of_date", days)
    of_touched = in_snapshots(contract.snapshot, days)
    failures = checks.layer_failures(valid.where(of_touched), rejected.where(of_touched), contract, staged_quote)
    checks.require_none(failures.where(~F.col("test_name").isin(*ungated)))

    def replace(
        frame: DataFrame, path: str, sort: Sequence[str] = (), balance: bool = True
    ) -> DataFrame:
        tables.write_partitions(
            frame,
            path,
            by=("as_of_date",),
            owned=[(d,) for d in days],
            sort=sort,
            balance=balance,
        )
        return spark.read.schema(frame.schema).parquet(path)

    fresh = star.enrich(staged.where(touched), contract.bands)
    # the refined files are split by snapshot already, and the fact is a projection of them
    fact = replace(
        star.fact_quotes(fresh), fact_path, sort=("route_id", "cabin_class"), balance=False
    )
    cube = replace(star.fare_cube(fact.where(touched)), cube_path)
    marts_by_day = {
        "mart_route_performance": marts.route_performance(cube.where(touched)),
        "mart_booking_leadtime_pricing": marts.lead_time_pricing(fact.where(touched)),
        "mart_airline_cabin_mix": marts.carrier_cabin_mix(cube.where(touched)),
        "mart_data_quality_summary": marts.data_quality_summary(
            marts.reason_table(staged.where(touched), turned_away.where(touched))
        ),
    }
    published = {"fct_flight_price_quote": fact.where(touched)}
    for name, frame in marts_by_day.items():
        published[name] = replace(frame, f"{lake.gold}/{name}").where(touched)
    dimensions = {
        "dim_airline": star.dim_carrier(cube),
        "dim_route": star.dim_route(cube),
        "dim_lead_time_bucket": star.dim_lead_time_band(spark, contract.bands),
    }
    for name, frame in dimensions.items():
        tables.write_table(frame, f"{lake.gold}/{name}")
        published[name] = spark.read.schema(frame.schema).parquet(f"{lake.gold}/{name}")
    if after_write is not None:
        after_write()
    values = {r.column: r.values for r in contract.rules if isinstance(r, OneOf)}
    source = {target: column for column, target, _ in staged_quote}
    airlines, cabins = values[source["airline_name"]], values[source["cabin_class"]]
    checks.require_none(checks.gold_failures(published, airlines, cabins, leave_out=ungated))
    read = [(d, True, list(runs.get(d, ()))) for d in days]
    entries = spark.createDataFrame(read, "as_of_date date, reconciled boolean, consumed array<string>")
    audit.append_run_log(spark, audit.run_log_rows(entries, "gold"), lake.run_log)
    return days
