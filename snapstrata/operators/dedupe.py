"""Pick one row per business key, also where one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

from snapstrata.contract import SnapshotContract
from snapstrata.session import freed_shuffles, work_area, writer
from snapstrata.sources import files

KEPT = "_kept"

def ordering(tiebreak: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col(c).asc() if way == "asc" else F.col(c).desc() for c, way in tiebreak]


def order_struct(df: DataFrame, tiebreak: Sequence[tuple[str, str]]) -> Column:
    """A struct whose smallest value belongs to the first row in ``tiebreak`` order.

    As in a window, ascending columns put NULL first and descending ones last.
    """
    parts: list[Column] = []
    for position, (name, direction) in enumerate(tiebreak):
        if direction == "asc":
            parts.append(F.col(name).alias(f"o{position}"))
        else:
            parts.append(F.col(name).isNull().alias(f"m{position}"))
            parts.append(_reversed(name, df.schema[name].dataType).alias(f"o{position}"))
    return F.struct(*parts)


def _reversed(name: str, kind: DataType) -> Column:
    c = F.col(name)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, DateType):
        return -F.unix_date(c)
    if isinstance(kind, BooleanType):
        return ~c
    if isinstance(kind, IntegralType):
        return -c.cast("decimal(20,0)")
    if isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return -c
    raise TypeError(f"cannot order {name} ({kind.simpleString()}) descending")


def keep_first(
    df: DataFrame, key: Sequence[str], tiebreak: Sequence[tuple[str, str]]
) -> DataFrame:
    """The first row of each key (NULL keys group together); ties go by a hash of the row, as in ``mark_winners``.

    Filtering on the first row number lets Spark limit every group on the map
    side, so each task ships at most one row per key whatever the skew.
    """
    by_key = Window.partitionBy("_hk", *key).orderBy(*ordering(tiebreak), F.xxhash64(*df.columns))
    ranked = df.withColumn("_hk", F.xxhash64(*key)).withColumn(
        "_place", F.row_number().over(by_key)
    )
    return ranked.where(F.col("_place") == 1).drop("_hk", "_place")


def is_plain_scan(df: DataFrame) -> bool:
    """Projections and filters over one table of files, nothing that could repeat or reorder its rows?"""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def with_row_identity(df: DataFrame) -> DataFrame:
    """Adds _file and _index, which tell all rows apart and stay the same in every reading.

    A plain scan of Parquet files has them; anything else is written to the shared folder first.
    """
    place = (F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    if is_plain_scan(df):
        try:
            return df.select("*", *place)
        except AnalysisException:  # files of a format without row numbers
            pass
    path = work_area(df.sparkSession, "rows")
    with freed_shuffles(df.sparkSession):
        writer(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select("*", *place)


#: rows of a file whose winners share one row of bits, and what such a row takes in a broadcast
BLOCK, WORD, BLOCK_BYTES = 4096, 64, 576


def key_hashes(key: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that tell keys apart: at 10^10 keys two share them with a chance of 10^-19.

    The hash leaves NULLs out, so they are hashed as such beside the values; -0.0 is 0.0, as in a group.
    """
    parts = [part for c in key for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit(len(parts)), *reversed(parts))


def _winners(placed: DataFrame, path: str) -> tuple[DataFrame, int, int]:
    """The place of the best row of every key, written; where a key repeats, with the key and the best order.

    Also the number of keys that repeat, and the bytes of these keys as text: what a broadcast would have to hold, whatever its files' size.
    """
    spark, seen = placed.sparkSession, Observation()
    best = placed.groupBy("_hk", "_dk").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeats = F.col("_rows") > 1
    told = [F.when(repeats, F.col(c)).alias(name) for c, name in (("_hk", "_bh"), ("_dk", "_bk"), ("_first", "_best"))]
    out = best.select(*told, F.col("_first._file").alias("_file"), F.col("_first._index").alias("_index"))
    text = F.octet_length(F.to_json(F.struct("_bh", "_bk", "_best")))
    size = F.coalesce(F.sum(F.when(F.col("_bh").isNotNull(), text)), F.lit(0).cast("long"))
    with freed_shuffles(spark):
        writer(out.observe(seen, F.count("_bh").alias("keys"), size.alias("size"))).parquet(path)
    found = seen.get
    return spark.read.schema(out.schema).parquet(path), found["keys"], found["size"]


def _winner_bits(winners: DataFrame, limit: int) -> list[DataFrame] | None:
    """The winners' places as a bit per row, cut by files into tables that may each be broadcast; None where a file's bits alone are too many."""
    spark, path = winners.sparkSession, work_area(winners.sparkSession, "bits")
    block, word = F.floor(F.col("_index") / BLOCK).cast("long"), F.floor(F.col("_index") / WORD).cast("long")
    bit = F.expr(f"shiftleft(1L, CAST(_index % {WORD} AS INT))")
    words = winners.groupBy("_file", block.alias("_block"), word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    held = F.map_from_entries(F.collect_list(F.struct((F.col("_word") % (BLOCK // WORD)).alias("w"), "_bits")))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BLOCK // WORD - 1).cast("long")), lambda w: F.coalesce(held[w], F.lit(0).cast("long")))
    with freed_shuffles(spark):
        writer(words.groupBy("_file", "_block").agg(every.alias("_words"))).parquet(path)
    bits = spark.read.schema("_file long, _block long, _words array<bigint>").parquet(path)
    # a row per file
    pieces, room = [], 0
    for r in bits.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).orderBy("_file").collect():
        need = r["n"] * BLOCK_BYTES
        if need > limit:
            return None
        if need > room:
            pieces.append([])
            room = limit
        pieces[-1].append(r["_file"])
        room -= need
    return [bits.where(F.col("_file").isin(files)) for files in pieces]


def mark_winners(
    df: DataFrame, key: Sequence[str], tiebreak: Sequence[tuple[str, str]], *, flag: str = KEPT
) -> DataFrame:
    """Keep all rows and add ``flag``: true on exactly one row per key.

    The best row of every key is a map-side combined minimum over (``tiebreak``,
    hash of the whole row, place in its file), so no task gathers a key to find it and equal rows
    are told apart.  Keys are shuffled as 128 bits of hash, see ``key_hashes``.  The places of the best rows are written, and with them the keys that repeat, of measured size: where no
    key repeats, no row moves at all; up to Spark's broadcast limit those keys are broadcast; beyond it the best rows'
    places are, as a bit per row, in as many tables below the limit as it takes, and again no row moves.
    Where the bits of one file are above the limit, one join on the key's hash brings the best to the rows, and adaptive
    execution splits a key that holds much of the table.  Files' sizes never decide.

    The search runs when this is called.  ``df`` is read twice; unless it is a plain scan of
    Parquet files its rows are written down first, so any plan will do.
    """
    columns = df.columns
    rows = with_row_identity(df)
    # columns of the key are equal wherever places are compared
    told = [(name, way) for name, way in tiebreak if name not in key]
    place = F.struct(order_struct(df, told).alias("order"), F.xxhash64(*columns).alias("row"), "_file", "_index")
    first_half, other_half = key_hashes(key)
    placed = rows.select(*columns, first_half.alias("_hk"), other_half.alias("_dk"), place.alias("_place"))
    written = work_area(df.sparkSession, "winners")
    winners, keys, size = _winners(placed, written)
    if not keys:
        return df.withColumn(flag, F.lit(True))
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if size > limit > 0 and (pieces := _winner_bits(winners, limit)) is not None:
        files.remove(df.sparkSession, written)
        return _marked_by_bits(rows, pieces, columns, flag)
    repeated = winners.where(F.col("_bh").isNotNull()).select("_bh", "_bk", "_best")
    repeated = F.broadcast(repeated) if size <= limit else repeated.hint("merge")
    # one hash alone is the join key, so both sides are shuffled for the join and adaptive
    # execution may split them; keys that share it are told apart behind it by the other
    own = (F.col("_hk") == F.col("_bh")) & F.array_contains(F.array("_bk"), F.col("_dk"))
    first = F.col("_best").isNull() | (F.col("_place") == F.col("_best"))
    return placed.join(repeated, own, "left").select(*columns, first.alias(flag))


def _marked_by_bits(rows: DataFrame, pieces: Sequence[DataFrame], columns: Sequence[str], flag: str) -> DataFrame:
    """``rows`` with the bit of their place; a file's bits are in one of the pieces."""
    out = rows.withColumn("_at", F.floor(F.col("_index") / BLOCK).cast("long"))
    for k, piece in enumerate(pieces):
        piece = piece.select(F.col("_file").alias(f"_file{k}"), F.col("_block").alias(f"_block{k}"), F.col("_words").alias(f"_words{k}"))
        same = (F.col("_file") == F.col(f"_file{k}")) & (F.col("_at") == F.col(f"_block{k}"))
        out = out.join(F.broadcast(piece), same, "left")
    words = F.coalesce(*[F.col(f"_words{k}") for k in range(len(pieces))])
    word = F.get(words, F.floor(F.col("_index") % BLOCK / WORD).cast("int"))
    won = F.coalesce(F.getbit(word, (F.col("_index") % WORD).cast("int")) == 1, F.lit(False))
    return out.select(*columns, won.alias(flag))


def deduplicate(
    df: DataFrame, key: Sequence[str], tiebreak: Sequence[tuple[str, str]]
) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): every input row is in exactly one of the two.

    ``tiebreak`` must tell the rows of a key apart for the two to fit together.
    """
    marked = mark_winners(df, key, tiebreak)
    return keep_first(df, key, tiebreak), marked.where(~F.col(KEPT)).drop(KEPT)


def mark_contract_winners(df: DataFrame, contract: SnapshotContract) -> DataFrame:
    """``mark_winners`` by the contract; needs ``is_valid`` when it prefers valid rows."""
    tiebreak = tuple(contract.tiebreak)
    if contract.prefer_valid:
        tiebreak = (("is_valid", "desc"),) + tiebreak
    return mark_winners(df, contract.business_key, tiebreak)


def group_sizes(df: DataFrame, key: Sequence[str], name: str = "variants") -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))


def multi_variant_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Groups that hold more than one row, with their size."""
    return group_sizes(df, key).where(F.col("variants") > 1)
