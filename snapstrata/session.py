"""Session facts the writers need.  Sessions themselves come from the caller."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from snapstrata.sources import files

#: settings the operators count on; pass them to the builder or to spark-submit
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot lookup key even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local-mode session without the setting (a test) gets a folder of its
    own; a cluster session without it is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="snapstrata-"))
    return context.getCheckpointDir().rstrip("/")


_PASSING: ContextVar[str | None] = ContextVar("_PASSING", default=None)


def work_area(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables, unique per call."""
    return f"{_PASSING.get() or f'{shared_dir(spark)}/snapstrata'}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def passing_areas(spark: SparkSession) -> Iterator[None]:
    """Work areas named inside are deleted at the end: nothing that outlives the block may read them."""
    folder = work_area(spark, "passing")
    token = _PASSING.set(folder)
    try:
        yield
    finally:
        _PASSING.reset(token)
        files.remove(spark, folder)


#: Spark deletes a query's shuffle files as soon as the query ends; by itself it waits for a garbage collection
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside are gone when its write ends, so that those of successive writes don't add up."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def writer(df: DataFrame) -> DataFrameWriter:
    """For Parquet files: zstd takes a quarter less than Spark's default codec."""
    return df.write.option("compression", "zstd")
