"""Names, first lines and renames of files, through the file system that Spark reads them by."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class File(NamedTuple):
    #: as Spark's readers take it
    path: str
    #: as ``_metadata.file_path`` spells it, see ``located``
    place: str


def _of(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _single_slash(place: str) -> str:
    return re.sub("^([a-z0-9]+):/+", r"\1:/", place)


def located() -> Column:
    """The file of a row, in the spelling of ``File.place``."""
    return F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):/+", "$1:/")


def files_of(spark: SparkSession, path: str) -> list[File]:
    """The files behind a path, a folder or a pattern, by name; hidden ones are none."""
    place, system = _of(spark, path)
    entries = []
    for entry in system.globStatus(place) or []:
        entries += system.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
    paths = [e.getPath() for e in entries if not e.isDirectory() and not e.getPath().getName().startswith(("_", "."))]
    return sorted(File(p.toString(), _single_slash(p.toUri().toString())) for p in paths)


def first_line_of(spark: SparkSession, path: str) -> str:
    """The first line of one text file, packed or not; no job runs for it."""
    place, system = _of(spark, path)
    jvm = spark._jvm
    stream = system.open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
        unpacked = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(unpacked, "UTF-8")).readLine()
    finally:
        stream.close()
    return "" if line is None else line.lstrip("\ufeff")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; what stands above the target is made, the target must not exist."""
    place, system = _of(spark, target)
    system.mkdirs(place.getParent())
    if system.exists(place) or not system.rename(_of(spark, source)[0], place):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    place, system = _of(spark, path)
    system.delete(place, True)
