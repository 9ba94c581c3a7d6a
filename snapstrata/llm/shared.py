"""Files in the folder that the driver and all executors share.

Spark's writers cover tables; operators whose result is a binary file format
write it from inside tasks.  Every attempt of a task writes under a name of its
own, and only the names that end up in a table that Spark committed count.  A
repeated or lost attempt thus leaves an unused file, never a damaged one.

Paths with the scheme ``file`` (a mounted file system) are opened and memory
mapped directly; others go through pyarrow's file systems.
"""

from __future__ import annotations

import os
import pickle
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from snapstrata.session import shared_dir


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below spark.checkpoint.dir; only a local session without the setting gets one of its own."""
    return f"{shared_dir(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read more than once, and read it again: this also cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, purpose)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shipped:
    """A broadcast object whose class travels with it, as functions of this package do."""

    def __init__(self, spark: SparkSession, value):
        self._held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._held.value)


def local_path(uri: str) -> str | None:
    """The path of a mounted file, or None for a store that isn't mounted."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return unquote(parsed.path)
    return None


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def attempt_name(stem: str, suffix: str) -> str:
    """A file name that no other attempt of any task uses."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb", buffering=1 << 20)
    filesystem, name = _filesystem(uri)
    return filesystem.open_output_stream(name)


def open_input(uri: str):
    path = local_path(uri)
    if path is not None:
        return open(path, "rb", buffering=1 << 20)
    filesystem, name = _filesystem(uri)
    return filesystem.open_input_file(name)


def mapped_array(uri: str, dtype) -> np.ndarray:
    """A file as an array: memory mapped where it is mounted, read otherwise."""
    path = local_path(uri)
    if path is not None:
        if os.path.getsize(path) == 0:
            return np.zeros(0, dtype=dtype)
        return np.memmap(path, dtype=dtype, mode="r")
    with open_input(uri) as source:
        return np.frombuffer(source.read(), dtype=dtype)
