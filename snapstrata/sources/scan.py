"""Scans under a contract, and lineage columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapstrata.contract import SnapshotContract
from snapstrata.sources.drift import gate_header, raw_header
from snapstrata.sources.files import located

CORRUPT = "_corrupt_record"


def scan_csv(
    spark: SparkSession, path: str, contract: SnapshotContract, *, allow_reorder: bool = True
) -> DataFrame:
    """Read a CSV under the contract's declared types; nothing is inferred.

    The declared fields are put into the order of the file's header, because a
    scan binds a given schema by position, and are then selected by name.  A
    padded name is scanned as the file spells it and gets the declared name
    behind the scan.  A line that does not parse keeps its text in ``_corrupt_record``.
    """
    rows = scan_alike(spark, [path], raw_header(spark, path), contract, allow_reorder=allow_reorder)
    return rows.drop("_located")


def scan_alike(
    spark: SparkSession, paths: Sequence[str], spelled: Sequence[str], contract: SnapshotContract, *, allow_reorder: bool = True
) -> DataFrame:
    """``scan_csv`` over files whose headers are spelled alike, as one scan."""
    declared = contract.source_schema
    names = [name.strip() for name in spelled]
    gate_header(names, declared, allow_reorder=allow_reorder)
    in_file_order = [StructField(raw, declared[name].dataType, True) for raw, name in zip(spelled, names)]
    schema = StructType(in_file_order + [StructField(CORRUPT, StringType(), True)])
    place = dict(zip(names, spelled))
    columns = [F.col("`" + place[n].replace("`", "``") + "`").alias(n) for n in declared.fieldNames()]
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(list(paths))
        .select(*columns, CORRUPT, F.col("_metadata.file_name").alias("_source_file"), located().alias("_located"))
    )


def resolve_snapshot(
    spark: SparkSession, path: str | None = None, explicit: str | date | None = None
) -> date:
    """The snapshot date: given, else AS_OF_DATE, else the file's age, else today."""
    chosen = explicit or os.environ.get("AS_OF_DATE")
    if chosen:
        return chosen if isinstance(chosen, date) else date.fromisoformat(chosen)
    if path:
        stamped = (
            spark.read.text(path)
            .select(F.col("_metadata.file_modification_time").cast("date").alias("d"))
            .first()
        )
        if stamped:
            return stamped["d"]
    return datetime.now(timezone.utc).date()


def new_batch_id(as_of_date: date) -> str:
    """``<snapshot>T<HHMMSS>-<random>``; the suffix separates runs of one second."""
    moment = datetime.now(timezone.utc).strftime("%H%M%S")
    return f"{as_of_date.isoformat()}T{moment}-{uuid.uuid4().hex[:8]}"


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, partition: str, location: str
) -> None:
    """Declare a table over files that already exist (or will)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (`{partition}`) LOCATION '{location}'"
    )


def register_partition(
    spark: SparkSession, name: str, partition: str, value: object, location: str
) -> None:
    """Make one partition visible; repeating it changes nothing."""
    spark.sql(
        f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{partition}`='{value}') "
        f"LOCATION '{location}'"
    )


def refresh_statistics(spark: SparkSession, name: str, columns: Sequence[str] = (), histograms: bool = False) -> None:
    """Size and row count of a table, and of the named columns what the cost-based optimiser goes by.

    All columns are measured in one scan; histograms take a second one.
    """
    if not columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
        return
    listed = ", ".join(f"`{c}`" for c in columns)
    before = spark.conf.get("spark.sql.statistics.histogram.enabled")
    spark.conf.set("spark.sql.statistics.histogram.enabled", str(histograms).lower())
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {listed}")
    finally:
        spark.conf.set("spark.sql.statistics.histogram.enabled", before)


def column_statistics(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """(column_name, row_count, nulls, min_value, max_value) as the catalog holds them; no row is read."""
    table = spark._jsparkSession.sessionState().catalog().getTableMetadata(
        spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name)
    )
    stats = table.stats().get()
    rows = str(stats.rowCount().get()) if stats.rowCount().isDefined() else None
    told = []
    for column in columns:
        shown = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
        values = [None if shown.get(k) in (None, "NULL") else shown[k] for k in ("num_nulls", "min", "max")]
        told.append((column, rows and int(rows), values[0] and int(values[0]), *values[1:]))
    return spark.createDataFrame(told, "column_name string, row_count long, nulls long, min_value string, max_value string")
