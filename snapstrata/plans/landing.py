"""Take delivered files into the raw layer, each once."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstrata.contract import SnapshotContract
from snapstrata.session import freed_shuffles, writer
from snapstrata.sources import audit, drift, files, fingerprint, scan, tables


class LandingError(RuntimeError):
    """The rows that landed are not those of the file."""


@dataclass(frozen=True)
class Lake:
    """Where the layers live under one root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/bronze"

    @property
    def refined(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def manifest(self) -> str:
        return f"{self.root}/audit/ingestion_manifest"

    @property
    def run_log(self) -> str:
        return f"{self.root}/audit/dq_run_log"


@dataclass(frozen=True)
class Landed:
    as_of_date: date
    batch_id: str
    file_hash: str
    #: False when the content had been taken in before and nothing was written
    taken: bool
    rows: int = 0


def land_file(
    spark: SparkSession,
    path: str,
    contract: SnapshotContract,
    lake: Lake,
    *,
    as_of_date: str | date | None = None,
    force: bool = False,
    merge_same_day: bool = False,
) -> Landed:
    """``land_files`` for one delivery: a file, a folder of parts, or a pattern."""
    (landed,) = land_files(spark, [(path, as_of_date)], contract, lake, force=force, merge_same_day=merge_same_day)
    return landed


def land_files(
    spark: SparkSession,
    deliveries: Sequence[tuple[str, str | date | None]],
    contract: SnapshotContract,
    lake: Lake,
    *,
    force: bool = False,
    merge_same_day: bool = False,
) -> list[Landed]:
    """Take in deliveries, given as (path, snapshot date), all together and each once.

    Header gate, one scan of the text into a folder that readers don't see, content identity
    per delivery from what arrived there, duplicate-delivery gate against the manifest and
    among the deliveries, publication, log, manifest, in this order.  How many jobs run does not depend
    on the number of deliveries.  Files whose headers are spelled alike are one scan.

    A later delivery for a snapshot replaces an earlier one; with ``merge_same_day`` its
    rows join the ones already there.  A delivery is published by renaming its folder, which is named
    by its content, so publishing it again changes nothing.  The manifest is written last, and
    nothing is published where the rows that arrived are not those that were read: an
    interrupted or failed run is simply repeated.
    """
    started = time.monotonic()
    days = [scan.resolve_snapshot(spark, path, day) for path, day in deliveries]
    batches = [scan.new_batch_id(day) for day in days]
    names = [path.rstrip("/").rsplit("/", 1)[-1] for path, _ in deliveries]
    staged, read_rows = _stage(spark, [path for path, _ in deliveries], batches, contract, lake)
    columns = [f.name for f in contract.source_schema.fields]
    columns = ["_source_row" if c == contract.row_number else c for c in columns]
    arrived = spark.read.parquet(staged)
    found = fingerprint.content_ids(arrived, (*columns, scan.CORRUPT), DELIVERY)
    contents = [found.get(k, (0, fingerprint.no_content())) for k in range(len(deliveries))]
    same = read_rows == sum(n for n, _ in contents)

    told = [(k, *row) for k, row in enumerate(zip(names, (h for _, h in contents), days, batches, (n for n, _ in contents)))]
    entries = spark.createDataFrame(told, f"{DELIVERY} int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in audit.MANIFEST_SCHEMA.fields[:5]))
    manifest = audit.read_manifest(spark, lake.manifest)
    fresh = set(range(len(told))) if force else {r[DELIVERY] for r in audit.new_deliveries(entries, manifest).select(DELIVERY).collect()}
    seen: set[tuple[str, date]] = set()
    taken = []
    for k, (_, _, content, day, _, _) in enumerate(told):
        if k in fresh and (content, day) not in seen:
            seen.add((content, day))
            taken.append(k)
    results = [Landed(days[k], batches[k], contents[k][1], k in taken, contents[k][0] if k in taken else 0) for k in range(len(told))]
    if not taken:
        files.remove(spark, staged)
        return results

    if same:
        last = {days[k]: k for k in taken}
        for k in taken if merge_same_day else sorted(last.values()):
            _publish(spark, staged, k, contents[k], days[k], contract, lake, merge_same_day)
    logged = [(days[k], names[k], contents[k][0], contents[k][0], same) for k in taken]
    entry = spark.createDataFrame(
        logged, "as_of_date date, source_file string, source_row_count long, bronze_row_count long, reconciled boolean"
    ).withColumn("runtime_seconds", F.lit(time.monotonic() - started))
    audit.append_run_log(spark, audit.run_log_rows(entry, "bronze", batches[taken[0]] if len(taken) == 1 else None), lake.run_log)
    if not same:
        raise LandingError(f"{', '.join(names)}: {read_rows} rows read, {sum(n for n, _ in contents)} landed")
    audit.record_deliveries(entries.where(F.col(DELIVERY).isin(*taken)).drop(DELIVERY), lake.manifest)
    files.remove(spark, staged)
    return results


#: number of a delivery within its landing
DELIVERY = "_delivery"


def _stage(spark: SparkSession, paths: Sequence[str], batches: Sequence[str], contract: SnapshotContract, lake: Lake) -> tuple[str, int]:
    """Scan the deliveries into a hidden folder, a folder each; returns it and the rows that were read."""
    held = [files.files_of(spark, path) for path in paths]
    # a file that belongs to several deliveries is scanned once
    alike: dict[tuple[str, ...], dict[str, files.File]] = {}
    for path, own in zip(paths, held, strict=True):
        if not own:
            raise LandingError(f"no file under {path}")
        # the parts of a delivery share the header of the first
        header = tuple(drift.header_names(files.first_line_of(spark, own[0].path)))
        alike.setdefault(header, {}).update((f.place, f) for f in own)
    scans = [scan.scan_alike(spark, [f.path for f in group.values()], header, contract) for header, group in alike.items()]
    rows = reduce(DataFrame.unionByName, scans)
    if len(paths) == 1:
        rows = rows.withColumns({DELIVERY: F.lit(0), "_batch_id": F.lit(batches[0])})
    else:
        # a row for each file name
        whose = [(f.place, k, batches[k]) for k, own in enumerate(held) for f in own]
        places = spark.createDataFrame(whose, f"_located string, {DELIVERY} int, _batch_id string")
        rows = rows.join(F.broadcast(places), "_located")
    lineage = rows.drop("_located").withColumnRenamed(contract.row_number, "_source_row")
    lineage = lineage.withColumn("_ingested_at", F.lit(audit.now_utc()).cast("timestamp"))
    staged = f"{lake.raw}/_landing/{batches[0]}-{uuid.uuid4().hex[:8]}"
    # counted apart from the files that are written: an inner join that lost rows would show
    read = Observation()
    sources = lineage.sortWithinPartitions(DELIVERY, "_source_row").observe(read, F.count(F.lit(1)).alias("n"))
    with freed_shuffles(spark):
        writer(sources).partitionBy(DELIVERY).parquet(staged)
    if not any(name.startswith(f"{DELIVERY}=") for name in _names(spark, staged)):
        spark.createDataFrame([], lineage.schema).write.mode("overwrite").parquet(staged)
    return staged, read.get["n"]


def _names(spark: SparkSession, path: str) -> list[str]:
    return [f"{DELIVERY}={v}" for v in tables.partition_names(spark, path, DELIVERY)]


def _publish(
    spark: SparkSession, staged: str, delivery: int, content: tuple[int, str], day: date, contract: SnapshotContract, lake: Lake, join: bool
) -> None:
    """Move a delivery's folder to its snapshot, under the name of its content."""
    own = f"{staged}/{DELIVERY}={delivery}"
    if not content[0]:
        schema = spark.read.parquet(staged).drop(DELIVERY).schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(own)
    target = f"{lake.raw}/{contract.snapshot}={day.isoformat()}"
    folder = f"_file_hash={content[1]}"
    old = f"{lake.raw}/_landing/replaced-{uuid.uuid4().hex}"
    # what is replaced goes out of sight as a whole, then the new folder comes in as a whole
    if not join and tables.exists(spark, target):
        files.move(spark, target, old)
    elif tables.exists(spark, f"{target}/{folder}"):
        files.move(spark, f"{target}/{folder}", old)
    files.move(spark, own, f"{target}/{folder}")
    files.remove(spark, old)
