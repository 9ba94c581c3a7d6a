"""Content identity of a delivery, independent of file name, file splits and row order.

Each row is hashed on its own and the hashes are added up, so the work is one
narrow aggregate however large the file is and no file passes through one task
as a whole.  Addition, unlike xor, does not let repeated rows cancel out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.sources.drift import first_line

FIELD_SEPARATOR = "\x1f"
NULL_MARK = "\x00"
#: starts an identity, so that a folder's name made of it is never taken for a number
CONTENT = "content-"


def _part(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(28,0)")


def _sums(rows: DataFrame, row_digest: Column, by: Sequence[str]) -> DataFrame:
    return (
        rows.select(*by, row_digest.alias("_digest"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(_part(F.col("_digest"), 1)).alias("_high"),
            F.sum(_part(F.col("_digest"), 17)).alias("_low"),
        )
    )


def _mixed(n: Column, high: Column, low: Column) -> Column:
    zero = F.lit(0).cast("decimal(38,0)")
    parts = (n, F.coalesce(high, zero), F.coalesce(low, zero))
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def table_fingerprint(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group: ``row_count`` and the ``file_hash`` over the given columns of its rows."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    sums = _sums(df, F.md5(F.concat_ws(FIELD_SEPARATOR, *parts)), by)
    mixed = _mixed(F.col("row_count"), F.col("_high"), F.col("_low"))
    return sums.select(*by, "row_count", mixed.alias("file_hash"))


def content_ids(df: DataFrame, columns: Sequence[str], by: str) -> dict[object, tuple[int, str]]:
    """Per group its rows and an identity of their content; one line per group reaches the driver."""
    return {r[by]: (r["row_count"], CONTENT + r["file_hash"]) for r in table_fingerprint(df, columns, (by,)).collect()}


def no_content() -> str:
    """The identity of a delivery without rows."""
    return CONTENT + hashlib.md5(b"0|0|0").hexdigest()


def _squeezed(line: Column) -> Column:
    """A header line without byte-order mark and padding, so that all parts' headers look alike."""
    return F.regexp_replace(line, "[\ufeff\\s]", "")


def file_fingerprint(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """(hash, data rows, files) of a delimited text file or a folder of such parts, in one pass.

    The header line of each part counts for nothing, so a delivery is the same
    however it is split.  Blank lines are no rows.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    header = _squeezed(F.lit(first_line(spark, path)))
    digest = F.md5("value")
    per_file = (
        lines.where(F.trim("value") != "")
        .groupBy("_file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_part(digest, 1)).alias("high"),
            F.sum(_part(digest, 17)).alias("low"),
            F.min(F.when(_squeezed(F.col("value")) == header, digest)).alias("head"),
        )
    )
    zero = F.lit(0).cast("decimal(28,0)")
    rows = F.coalesce(F.sum(F.col("n") - F.col("head").isNotNull().cast("long")), F.lit(0))
    high, low = (
        F.sum(F.col(name) - F.coalesce(_part(F.col("head"), start), zero))
        for name, start in (("high", 1), ("low", 17))
    )
    row = per_file.agg(
        _mixed(rows, high, low).alias("file_hash"), rows.alias("rows"), F.count(F.lit(1)).alias("files")
    ).first()
    return row["file_hash"], row["rows"], row["files"]
