"""The two control tables: which deliveries were taken in, and how each run went."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from snapstrata.sources.tables import append_rows, read_or_empty

# ---- fixed values: the columns of the two control tables ----
MANIFEST_SCHEMA = StructType(
    [
        StructField("source_file", StringType()),
        StructField("file_hash", StringType()),
        StructField("as_of_date", DateType()),
        StructField("batch_id", StringType()),
        StructField("source_row_count", LongType()),
        StructField("ingested_at", TimestampType()),
    ]
)

RUN_LOG_SCHEMA = StructType(
    [
        StructField("layer", StringType()),
        StructField("batch_id", StringType()),
        StructField("as_of_date", DateType()),
        StructField("source_file", StringType()),
        StructField("source_row_count", LongType()),
        StructField("bronze_row_count", LongType()),
        StructField("silver_valid_count", LongType()),
        StructField("silver_rejected_count", LongType()),
        StructField("duplicates_removed", LongType()),
        StructField("multi_variant_quote_groups", LongType()),
        StructField("rejected_pct", DecimalType(9, 4)),
        StructField("reconciled", BooleanType()),
        StructField("rejection_reason_breakdown", StringType()),
        StructField("logged_at", TimestampType()),
        StructField("runtime_seconds", DoubleType()),
    ]
)
# ---- end of fixed values ----

# what tells runs apart, and the ids of the deliveries or runs of the layer before that a run has read
RUN_LOG_SCHEMA = RUN_LOG_SCHEMA.add("run_id", StringType()).add("consumed", ArrayType(StringType()))


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MANIFEST_SCHEMA)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUN_LOG_SCHEMA)


def already_ingested(manifest: DataFrame, file_hash: str, as_of_date: date) -> bool:
    """Was exactly this content taken in for this snapshot before?"""
    hit = manifest.where((F.col("file_hash") == file_hash) & (F.col("as_of_date") == as_of_date))
    return not hit.isEmpty()


def new_deliveries(deliveries: DataFrame, manifest: DataFrame) -> DataFrame:
    """The deliveries whose (content, snapshot) the manifest does not know yet."""
    return deliveries.join(
        manifest.select("file_hash", "as_of_date"), ["file_hash", "as_of_date"], "left_anti"
    )


def repeated_deliveries(deliveries: DataFrame, manifest: DataFrame) -> DataFrame:
    return deliveries.join(
        manifest.select("file_hash", "as_of_date"), ["file_hash", "as_of_date"], "left_semi"
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a fixed schema, filling columns the frame lacks with NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def record_deliveries(deliveries: DataFrame, path: str) -> None:
    """Enter deliveries, one or many, into the manifest; columns they lack stay NULL."""
    stamped = deliveries.withColumn("ingested_at", F.lit(now_utc()))
    append_rows(conform(stamped, MANIFEST_SCHEMA), path)


def deliveries(manifest: DataFrame) -> DataFrame:
    """(as_of_date, id) of every delivery that was taken in."""
    return manifest.select("as_of_date", F.col("batch_id").alias("id"))


def finished_runs(log: DataFrame, layer: str) -> DataFrame:
    """(as_of_date, id) of every run of a layer that added up; entries of older logs go by their batch or time."""
    run = F.coalesce("run_id", "batch_id", F.col("logged_at").cast("string"))
    return log.where((F.col("layer") == layer) & F.col("reconciled")).select("as_of_date", run.alias("id"))


def not_consumed(produced: DataFrame, log: DataFrame, layer: str) -> DataFrame:
    """(as_of_date, ids): what the layer before produced and no finished run of ``layer`` has read.

    An anti-join on ids.  Clock times would lose what is produced while a run is under way:
    the run has not read it, yet its entry is the newer one.
    """
    used = log.where((F.col("layer") == layer) & F.col("reconciled")).select(
        F.col("as_of_date").alias("used_date"), F.explode("consumed").alias("used_id")
    )
    same = F.col("as_of_date").eqNullSafe(F.col("used_date")) & (F.col("id") == F.col("used_id"))
    return produced.join(used, same, "left_anti").groupBy("as_of_date").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def by_snapshot(pending: DataFrame) -> dict[date | None, list[str]]:
    """Collected on purpose: a row per snapshot that waits for its next layer."""
    return {r["as_of_date"]: list(r["ids"]) for r in pending.collect()}


def in_order(days: Sequence[date | None]) -> list[date | None]:
    """Each snapshot once, by date; None, for rows without one, comes last."""
    found = set(days)
    return sorted(d for d in found if d is not None) + [None] * (None in found)


def run_log_rows(metrics: DataFrame, layer: str, batch_id: str | None = None) -> DataFrame:
    """Metric rows in the shape of the run log (every layer writes the same columns), under an id of this run."""
    run = {"run_id": F.lit(uuid.uuid4().hex), "logged_at": F.lit(now_utc())}
    stamped = metrics.withColumns({"layer": F.lit(layer), "batch_id": F.lit(batch_id), **run})
    return conform(stamped, RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, rows: DataFrame, path: str) -> list[Row]:
    """Append log rows (one per snapshot of the run) and hand them back."""
    entries = rows.collect()
    append_rows(spark.createDataFrame(entries, RUN_LOG_SCHEMA).coalesce(1), path)
    return entries
