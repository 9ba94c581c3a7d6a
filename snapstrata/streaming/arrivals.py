"""Files and rows that keep arriving, handled by the batch operators.

A run takes everything that is there and stops (``availableNow``).  The stream's
checkpoint remembers which files were seen; content that comes back under a new
name is caught by the manifest or by the key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.contract import SnapshotContract
from snapstrata.operators.dedupe import keep_first
from snapstrata.operators.merge import in_snapshots, partition_values
from snapstrata.plans.build import take_in_all
from snapstrata.plans.landing import Lake
from snapstrata.session import work_area
from snapstrata.sources import tables
from snapstrata.sources.audit import in_order


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Process everything available in micro-batches, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def take_in_arrivals(
    spark: SparkSession,
    inbox: str,
    contract: SnapshotContract,
    lake: Lake,
    checkpoint: str,
    snapshot_of: Callable[[str], str | date | None] = lambda path: None,
    files_per_batch: int = 16,
    merge_same_day: bool = False,
) -> None:
    """Take in each file that appears under ``inbox`` once.

    A micro-batch lists at most ``files_per_batch`` file names on the driver
    (only names: the content column is never read); the rows of each file are
    read, judged and written by the executors.  The files of a micro-batch are landed and refined
    together, by a number of jobs that does not grow with them; of several files for a snapshot the last
    one by name stands, or with ``merge_same_day`` all of them.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(inbox)
        .select("path")
    )

    def handle(batch: DataFrame, _batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.distinct().collect())
        if paths:
            found = [(path, snapshot_of(path)) for path in paths]
            take_in_all(batch.sparkSession, found, contract, lake, merge_same_day=merge_same_day)

    run_available(arrivals, handle, checkpoint)


#: bucket folders of a key index; fixed over the life of a table
INDEX_BUCKETS = 32


class KeyIndex:
    """In which partitions the keys of a table sit: (key, snapshot) rows in folders by the key's hash.

    A look-up reads the folders of the keys that are asked for, and no row of the table.  An index
    may name a partition that a key has left, never miss one that holds it: entries are written before the
    table is, with the partitions that hold a key now and the one it goes to.  What a key has left is
    dropped when the key comes again.
    """

    def __init__(self, path: str, key: Sequence[str], snapshot: str, buckets: int = INDEX_BUCKETS):
        self.path, self.key, self.snapshot, self.buckets = path, list(key), snapshot, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def entries(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.key, self.snapshot, self.bucket())

    def read(self, like: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """Entries of some buckets; ``like`` has the types."""
        return tables.read_or_empty(like.sparkSession, self.path, self.entries(like).schema).where(F.col("bucket").isin(*buckets))

    def of(self, rows: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows whose key is among ``keys``; NULL equals NULL."""
        return self._beside(rows, keys, "left_semi")

    def _beside(self, rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        theirs = keys.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(self.key)]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(self.key)]
        return rows.join(theirs, reduce(and_, same), how)

    def replace(self, held: DataFrame, keys: DataFrame, entries: DataFrame, buckets: Sequence[int]) -> None:
        """Put ``entries`` in the place of what the index has of ``keys``; other keys of the buckets stay."""
        others = self._beside(held, keys, "left_anti").select(*entries.columns)
        staged = work_area(held.sparkSession, "index")
        others.unionByName(entries.distinct()).write.parquet(staged)
        fresh = held.sparkSession.read.schema(entries.schema).parquet(staged)
        tables.write_partitions(fresh, self.path, by=("bucket",), owned=[(b,) for b in buckets], sort=self.key)


def merge_arrivals(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    *,
    key: Sequence[str],
    tiebreak: Sequence[tuple[str, str]],
    snapshot: str,
    index: str | None = None,
    index_buckets: int = INDEX_BUCKETS,
) -> None:
    """Merge streamed rows into a table partitioned by ``snapshot``, one row per key.

    Late rows go to the partition of their own date, rows without one to the
    partition of NULL; nothing is dropped.  A key that comes with another date leaves its old
    partition: an index beside the table (``KeyIndex``, by default in ``<target>_keys``)
    says where the keys of a micro-batch sit, so only those partitions and the batch's own are read and
    replaced.  Where a table has no index yet, it is made once from the table's keys.
    A replayed micro-batch finds its rows already there and changes nothing.
    """
    places = KeyIndex(index or f"{target.rstrip('/')}_keys", key, snapshot, index_buckets)

    def handle(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        # the batch is read several times below; write it down rather than rely on caches
        arrived = work_area(spark, "arrived")
        batch.write.parquet(arrived)
        batch = spark.read.schema(batch.schema).parquet(arrived)
        stored = tables.read_or_empty(spark, target, batch.schema).select(*batch.columns)
        if not tables.exists(spark, places.path) and tables.exists(spark, target):
            every = [(b,) for b in range(index_buckets)]
            tables.write_partitions(places.entries(stored).distinct(), places.path, by=("bucket",), owned=every, sort=key)
        # at most one value per bucket
        buckets = [r["bucket"] for r in batch.select(places.bucket()).distinct().collect()]
        if not buckets:
            return
        held = places.read(batch, buckets)
        days = in_order([*partition_values(batch, snapshot), *partition_values(places.of(held, batch), snapshot)])
        present = stored.where(in_snapshots(snapshot, days))
        staged = work_area(spark, "arrivals")
        keep_first(present.unionByName(batch), key, tiebreak).write.parquet(staged)
        merged = spark.read.schema(batch.schema).parquet(staged)
        now = places.of(places.entries(present.unionByName(merged)), batch)
        places.replace(held, batch, now, buckets)
        tables.write_partitions(merged, target, by=(snapshot,), owned=[(d,) for d in days])

    run_available(stream, handle, checkpoint)


def drop_repeats(stream: DataFrame, event_time: str, key: Sequence[str], within: str) -> DataFrame:
    """Row-level duplicate guard on an unbounded stream, with bounded state."""
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(key))
