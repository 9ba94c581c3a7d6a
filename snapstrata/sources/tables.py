"""Partitioned Parquet tables: idempotent writes, empty partitions, incremental loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstrata.operators import merge
from snapstrata.session import freed_shuffles, work_area, writer


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty one where the path does not exist.

    Every other failure is raised: an unreadable control table must not look
    like a new one.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


#: what partitioned tables call the partition of NULL
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def leaf(by: Sequence[str], values: Sequence[object]) -> str:
    return "/".join(f"{c}={NO_VALUE if v is None else v}" for c, v in zip(by, values, strict=True))


def partition_names(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, from the folder names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def partition_dates(spark: SparkSession, path: str, column: str) -> list[date | None]:
    """``partition_names`` as dates; None stands for the partition of rows without one."""
    names = partition_names(spark, path, column)
    return [None if name == NO_VALUE else date.fromisoformat(name) for name in names]


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    owned: Sequence[Sequence[object]] = (),
    sort: Sequence[str] = (),
    *,
    balance: bool = True,
    cluster: Sequence[str] = (),
    files: int | None = None,
) -> list[str]:
    """Replace the partitions present in ``df`` and leave all others alone.

    ``owned`` lists partitions this batch answers for: those it brings no rows
    for are replaced by an empty, typed partition, so that rows an earlier run
    wrote there do not linger.  Returns the partitions that received rows.

    Where rows of many partitions are mixed in every task, ``balance`` gathers
    them first; the hint lets adaptive execution split a partition that holds a
    large share of the rows over many files and merge small ones.  Turn it off
    where each task already holds rows of few partitions (one snapshot, or files
    of a table partitioned the same way): the write then moves no rows.  Sorting
    inside the files keeps Parquet min/max statistics selective within a file.

    ``cluster`` also spreads rows over files by ranges of those columns, sampled over the whole batch, so
    that a file holds a narrow range and a filter on the columns leaves few files over.  A value that
    holds much of the batch is cut over several files by a hash of the row.  ``files`` is the number of ranges
    (by default the shuffle partitions).
    """
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in by]
    seen = Observation()
    if cluster:
        ranges = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cut = df.withColumn("_cut", F.xxhash64(*df.columns))
        out = cut.repartitionByRange(ranges, *by, *cluster, "_cut").drop("_cut")
    else:
        out = df.hint("rebalance", *by) if balance else df
    if sort or cluster:
        # partitions first, as the writer wants them: it would sort once more otherwise, and not by ``sort``
        out = out.sortWithinPartitions(*by, *(sort or cluster))
    # one value per partition written, and set semantics survive task retries
    out = out.observe(seen, F.collect_set(F.concat_ws("/", *parts)).alias("filled"))
    with freed_shuffles(df.sparkSession):
        (
            writer(out)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )
    filled = set(seen.get["filled"] or [])
    hollow = [leaf(by, v) for v in owned if leaf(by, v) not in filled]
    if hollow:
        empty = df.sparkSession.createDataFrame([], StructType(df.drop(*by).schema.fields))
        for place in hollow:
            empty.write.mode("overwrite").parquet(f"{path}/{place}")
    return sorted(filled)


def write_table(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """Full rebuild of an unpartitioned table."""
    out = df.sortWithinPartitions(*sort) if sort else df
    with freed_shuffles(df.sparkSession):
        writer(out).mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def watermark(spark: SparkSession, path: str, column: str, kind: str = "date"):
    """Largest value already loaded, or None; read first so it prunes as a literal."""
    if not exists(spark, path):
        return None
    return spark.read.schema(f"`{column}` {kind}").parquet(path).agg(F.max(column)).first()[0]


def load_incrementally(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: Sequence[str],
    snapshot: str,
    *,
    mode: str = "replace",
    update: Sequence[str] = (),
    sort: Sequence[str] = (),
    keys_stay: bool = False,
) -> list:
    """Bring ``batch`` into the table, touching only the snapshots it contains.

    * ``replace``: the batch is the whole content of its snapshots.
    * ``delete_insert``: rows sharing a key with the batch go, batch rows come in.
    * ``upsert``: matching rows get the ``update`` columns, new keys are inserted.

    Rows without a snapshot are a partition like any other.  Where the key does not
    name the snapshot, a key of the batch may sit in another partition of the table;
    those partitions are found and rewritten as well, so that the key moves.
    ``keys_stay`` saves that search where a key's snapshot never changes.  An upsert refuses
    a batch that repeats a key, before anything is written.

    The batch and the merged rows are written to the shared work folder before the
    target's partitions are replaced, so nothing is read from a table that is being
    rewritten.  Partitions are replaced one by one: a run that fails in between leaves
    some of them new and some old, and is repaired by running it again.
    """
    if mode not in ("replace", "delete_insert", "upsert"):
        raise ValueError(f"unknown load mode {mode!r}")
    arrived = work_area(spark, "batch")
    batch.write.parquet(arrived)
    batch = spark.read.schema(batch.schema).parquet(arrived)
    if mode == "upsert":
        repeated = merge.repeated_keys(batch, key).first()
        if repeated is not None:
            raise ValueError(f"the batch holds a key {repeated['n']} times: {[repeated[k] for k in key]}")
    days = merge.partition_values(batch, snapshot)
    if mode != "replace" and exists(spark, path):
        if snapshot not in key and not keys_stay:
            elsewhere = spark.read.schema(batch.schema).parquet(path).join(batch.select(*key), list(key), "left_semi")
            known = {*days, *merge.partition_values(elsewhere, snapshot)}
            days = sorted(d for d in known if d is not None) + [None] * (None in known)
        current = (
            spark.read.schema(batch.schema)
            .parquet(path)
            .where(merge.in_snapshots(snapshot, days))
            .select(*batch.columns)
        )
        if mode == "delete_insert":
            merged = merge.delete_insert(current, batch, key)
        else:
            merged = merge.upsert(current, batch, key, update)
        staged = work_area(spark, "merge")
        merged.write.parquet(staged)
        batch = spark.read.schema(merged.schema).parquet(staged)
    write_partitions(batch, path, by=(snapshot,), owned=[(d,) for d in days], sort=sort)
    return days


def load_staging(spark: SparkSession, path: str, staging: str, snapshot: str, day: str) -> DataFrame:
    """Empty the staging table, then fill it evenly with one partition of ``path``.

    Staging is written once and read once, so its files are balanced by size
    and carry no key order.
    """
    rows = spark.read.parquet(path).where(F.col(snapshot) == F.lit(day).cast("date"))
    rows.hint("rebalance").write.mode("overwrite").parquet(staging)
    return spark.read.parquet(staging)


def save_bucketed(
    df: DataFrame, name: str, path: str, key: Sequence[str], buckets: int, sort: Sequence[str] = ()
) -> None:
    """Save a table hashed on ``key`` into a fixed number of buckets.

    Tables bucketed alike on their join key join without moving rows.  Choose
    the key by its number of distinct values: few values (such as routes) would
    leave most buckets empty and put a frequent value into one.
    """
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *key).sortBy(*(sort or key)).saveAsTable(name)


def hot_and_cold(hot: DataFrame, cold: DataFrame, snapshot: str, boundary: str) -> DataFrame:
    """One view over a recent and an archived copy, split at a date so no row shows twice."""
    edge = F.lit(boundary).cast("date")
    return hot.where(F.col(snapshot) >= edge).unionByName(cold.where(F.col(snapshot) < edge))


def publish_snapshots(
    spark: SparkSession, name: str, rows: DataFrame, root: str, snapshot: str, before_publish: Callable[[], None] | None = None
) -> list[date | None]:
    """Bring new versions of snapshots into a catalog table, each by pointing its partition to a fresh folder.

    Nothing that readers see is touched while rows are written.  A run that fails in between
    leaves the table as it was, and is simply repeated; what it wrote is never read.  The partitions of a
    version are switched one by one after all of them are written, each in the catalog alone.
    Older versions stay in their folders for readers under way; clean them when none is left.
    The table is declared at the first publication.
    """
    version = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    write_partitions(rows, version, by=(snapshot,))
    days = partition_dates(spark, version, snapshot)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{snapshot}`) LOCATION '{root}'")
    if before_publish is not None:
        before_publish()
    for day in days:
        value = "NULL" if day is None else f"'{day.isoformat()}'"
        place = f"{version}/{leaf((snapshot,), (day,))}"
        # the first version of a partition is added with its place, a later one is switched
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{snapshot}`={value}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {name} PARTITION (`{snapshot}`={value}) SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return days
