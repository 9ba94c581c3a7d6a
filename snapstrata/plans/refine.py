"""Raw snapshot rows in, judged rows out; and the job that writes them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.contract import REJECTED, VALID, SnapshotContract
from snapstrata.operators.dedupe import KEPT, keep_first, mark_contract_winners
from snapstrata.operators.merge import in_snapshots
from snapstrata.operators.reconcile import snapshot_metrics
from snapstrata.operators.standardize import clean, derive
from snapstrata.operators.validate import IS_VALID, OUTCOME, REASON_TEXT, judge, settle
from snapstrata.session import passing_areas
from snapstrata.sources import audit, tables


class EmptyInputError(RuntimeError):
    """Nothing to refine: the requested snapshots hold no raw rows."""


class ReconciliationError(RuntimeError):
    """Written rows do not add up to the raw rows."""


def refine(raw: DataFrame, contract: SnapshotContract) -> DataFrame:
    """Every raw row once, with ``outcome`` and ``rejection_reason``.

    Duplicates are searched on cleaned source columns, before anything is
    derived, so its shuffle carries source columns only; keys, derived columns
    and verdicts are computed behind it.  A contract that prefers valid rows needs
    the verdicts first.
    """
    cleaned = clean(raw, contract)
    if contract.prefer_valid:
        judged = judge(derive(cleaned, contract), contract.rules)
        return settle(mark_contract_winners(judged, contract), contract, KEPT)
    marked = mark_contract_winners(cleaned, contract)
    return settle(judge(derive(marked, contract), contract.rules), contract, KEPT)


def accepted_rows(raw: DataFrame, contract: SnapshotContract) -> DataFrame:
    """The valid rows of ``refine`` and nothing else, in one reading of ``raw``.

    A valid row has won its key, and winners alone need no more than a row per key and
    task in the shuffle.
    """
    if contract.prefer_valid:
        return valid_rows(refine(raw, contract), contract)
    winners = keep_first(clean(raw, contract), contract.business_key, contract.tiebreak)
    judged = judge(derive(winners, contract), contract.rules)
    return judged.where(IS_VALID).select(*contract.output)


def valid_rows(refined: DataFrame, contract: SnapshotContract) -> DataFrame:
    return refined.where(F.col(OUTCOME) == VALID).select(*contract.output)


def rejected_rows(refined: DataFrame, contract: SnapshotContract) -> DataFrame:
    return refined.where(F.col(OUTCOME) == REJECTED).select(*contract.output, REASON_TEXT)


@dataclass(frozen=True)
class RefinedTables:
    """Where the two halves of a refined table live."""

    root: str

    @property
    def valid(self) -> str:
        return f"{self.root}/{OUTCOME}={VALID}"

    @property
    def rejected(self) -> str:
        return f"{self.root}/{OUTCOME}={REJECTED}"

    def read_valid(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.valid).drop(REASON_TEXT)

    def read_rejected(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.rejected)

    def snapshots(self, spark: SparkSession, snapshot: str) -> set[date | None]:
        """Those that either half holds, from the folder names."""
        return {d for path in (self.valid, self.rejected) for d in tables.partition_dates(spark, path, snapshot)}


def as_dates(snapshots: Sequence[str | date | None]) -> list[date | None]:
    return [date.fromisoformat(s) if isinstance(s, str) else s for s in snapshots]


def refine_snapshots(
    spark: SparkSession,
    raw_path: str,
    refined_path: str,
    log_path: str,
    contract: SnapshotContract,
    snapshots: Sequence[str | date | None] | None = None,
    batch_id: str | None = None,
    manifest_path: str | None = None,
    after_write: Callable[[], None] | None = None,
) -> DataFrame:
    """Refine the given snapshots (all when None), write both halves, log, reconcile.

    Both halves come out of one write, partitioned by outcome and snapshot, so
    the plan runs once.  Raw rows without a snapshot date are a partition of their own, named by None.
    The counts that are logged and compared are read back
    from the written tables.  Returns the log rows of this run.

    With ``manifest_path`` the log also says which deliveries the run has read.  They are looked
    up before the raw rows: a delivery that lands meanwhile is not among them and stays
    to be refined, whether or not this run saw rows of it.  ``after_write`` is called between the write and the log.
    """
    snap = contract.snapshot
    waiting = {}
    if manifest_path is not None:
        known = audit.deliveries(audit.read_manifest(spark, manifest_path))
        waiting = audit.by_snapshot(audit.not_consumed(known, audit.read_run_log(spark, log_path), "silver"))
    raw = spark.read.parquet(raw_path)
    asked = None if snapshots is None else as_dates(snapshots)
    if asked is not None:
        raw = raw.where(in_snapshots(snap, asked))
    raw_counts = raw.groupBy(F.col(snap).cast("date").alias(snap)).agg(F.count(F.lit(1)).alias("bronze_row_count"))
    # one row per snapshot date: bounded by the calendar, not by the data
    sizes = {r[0]: r[1] for r in raw_counts.collect()}
    # a snapshot that lost all its raw rows is emptied on both sides as well
    held = RefinedTables(refined_path).snapshots(spark, snap)
    owned = audit.in_order([*sizes, *(d for d in asked or () if d in held)])
    if not owned:
        raise EmptyInputError(f"no raw rows under {raw_path} for {snapshots or 'any snapshot'}")

    columns = [c for c in contract.output if c != snap]
    # what marking the winners wrote is of no use once the rows are written
    with passing_areas(spark):
        refined = refine(raw, contract).select(*columns, REASON_TEXT, OUTCOME, snap)
        tables.write_partitions(
            refined,
            refined_path,
            by=(OUTCOME, snap),
            owned=[(side, day) for side in (VALID, REJECTED) for day in owned],
            sort=(contract.group_column,),
            # the raw files are split by snapshot, and marking the winners leaves rows where they are
            balance=False,
        )
    if after_write is not None:
        after_write()

    written = spark.read.parquet(refined_path).where(in_snapshots(snap, owned))
    every = [(d, sizes.get(d, 0), waiting.get(d, [])) for d in owned]
    told = spark.createDataFrame(every, f"`{snap}` date, bronze_row_count long, consumed array<string>")
    written = written.withColumn(snap, F.col(snap).cast("date"))
    metrics = snapshot_metrics(written, told.drop("consumed"), contract)
    read = told.select(F.col(snap).alias("_day"), "consumed")
    metrics = metrics.join(read, F.col(snap).eqNullSafe(F.col("_day")), "left").drop("_day")
    log = audit.run_log_rows(metrics, layer="silver", batch_id=batch_id)
    entries = audit.append_run_log(spark, log, log_path)
    broken = [str(r["as_of_date"]) for r in entries if not r["reconciled"]]
    if broken:
        raise ReconciliationError(f"valid + rejected differ from raw rows for {', '.join(broken)}")
    return spark.createDataFrame(entries, audit.RUN_LOG_SCHEMA)
