"""Bring the values of a large table to rows by its key, without moving the rows where that can be."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, IntegralType, StringType, StructField, StructType

from snapstrata.session import freed_shuffles, work_area, writer

#: keys that share a row of codes (two to the power of SHIFT), and what such a row takes in a broadcast
SHIFT, BLOCK_BYTES = 9, 1280
BLOCK = 1 << SHIFT
#: different combinations of values, and tables of codes, beyond which rows are shuffled to the table
MOST_KINDS, MOST_PIECES = 32_767, 16


def look_up(rows: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with ``table`` on ``column`` = ``key``.

    A table below Spark's broadcast limit is left to Spark.  Above it, where the table has few different combinations
    of values, the numbers of these combinations are broadcast, an array for each stretch of keys, in
    tables that are each below the limit.  Everything is measured when this is called; many combinations,
    repeated keys, sparse keys or values that have no exact equality mean the plain join, with a shuffle of both sides.
    """
    plain = rows.join(table, F.col(column) == F.col(key), "left")
    spark = table.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    told = [f for f in table.schema.fields if f.name != key]
    exact = all(isinstance(f.dataType, (StringType, IntegralType, DecimalType, DateType, BooleanType)) for f in told)
    integral = all(isinstance(frame.schema[c].dataType, IntegralType) for frame, c in ((rows, column), (table, key)))
    if size <= limit or limit <= 0 or not (told and exact and integral):
        return plain
    found = table.select(*[f.name for f in told]).distinct().limit(MOST_KINDS + 1).collect()
    if len(found) > MOST_KINDS or sum(len(str(r)) for r in found) > limit:
        return plain
    named = [StructField(f"_{f.name}", f.dataType) for f in told]
    kinds = spark.createDataFrame([(n, *r) for n, r in enumerate(found, 1)], StructType([StructField("_code", IntegerType()), *named]))
    blocks, count, repeated = _blocks(table, key, [f.name for f in told], kinds)
    pieces = max(1, -(-count * BLOCK_BYTES // limit))
    if repeated or pieces > MOST_PIECES:
        return plain
    out = rows
    for k in range(pieces):
        piece = blocks.where(F.pmod("_block", F.lit(pieces)) == k).select(F.col("_block").alias(f"_block{k}"), F.col("_codes").alias(f"_codes{k}"))
        out = out.join(F.broadcast(piece), F.shiftright(F.col(column).cast("long"), SHIFT) == F.col(f"_block{k}"), "left")
    codes = F.coalesce(*[F.col(f"_codes{k}") for k in range(pieces)])
    held = F.get(codes, F.col(column).bitwiseAND(F.lit(BLOCK - 1)).cast("int"))
    out = out.select(*rows.columns, held.cast("int").alias("_held")).join(F.broadcast(kinds), F.col("_held") == F.col("_code"), "left")
    known = F.when(F.col("_code").isNotNull(), F.col(column)).alias(key)
    return out.select(*rows.columns, known, *[F.col(f"_{f.name}").alias(f.name) for f in told])


def _blocks(table: DataFrame, key: str, values: list[str], kinds: DataFrame) -> tuple[DataFrame, int, bool]:
    """The codes of all keys, written; how many blocks there are, and whether a key repeats."""
    spark, path, seen = table.sparkSession, work_area(table.sparkSession, "codes"), Observation()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in values])
    block, at = F.shiftright(F.col(key).cast("long"), SHIFT).alias("_block"), F.col(key).bitwiseAND(F.lit(BLOCK - 1)).cast("int").alias("at")
    coded = table.where(F.col(key).isNotNull()).join(F.broadcast(kinds), same)
    # a row per key first, so that a key that repeats many times is not gathered
    keys = coded.groupBy(block, at).agg(F.min("_code").cast("short").alias("code"), F.count(F.lit(1)).alias("_n"))
    held = F.sort_array(F.collect_list(F.struct("at", "code"))).alias("_held")
    out = keys.groupBy("_block").agg(held, F.max("_n").alias("_n"))
    out = out.observe(seen, F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("_n") > 1).alias("repeated"))
    with freed_shuffles(spark):
        writer(out.drop("_n")).parquet(path)
    rows = spark.read.schema("_block long, _held array<struct<at: int, code: smallint>>").parquet(path)

    def spaced(x: Column, i: Column) -> Column:
        """The code behind as many zeros as there are keys missing before it."""
        before = F.coalesce(F.get(F.col("_held"), i - 1)["at"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("short"), x["at"] - before - 1), F.array(x["code"]))

    blocks = rows.select("_block", F.flatten(F.transform("_held", spaced)).alias("_codes"))
    return blocks, seen.get["blocks"], seen.get["repeated"] > 0
