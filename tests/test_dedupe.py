from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapstrata.operators.dedupe import deduplicate, keep_first, mark_winners
from snapstrata.sources.tables import write_partitions

SCHEMA = "id long, k1 string, k2 int, at timestamp_ntz, score double, rank int"
ORDER = (("at", "desc"), ("score", "desc"), ("rank", "asc"), ("id", "asc"))


def sample(spark, n=600, hot_share=0.34, seed=3):
    """A third of the rows on one key, NULLs in keys and ordering columns."""
    rng = random.Random(seed)
    from datetime import datetime, timedelta

    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        rows.append(
            (
                i,
                "hot" if hot else rng.choice(["a", "b", "c", None]),
                7 if hot else rng.choice([*range(30), None]),
                rng.choice([None, datetime(2024, 1, 1) + timedelta(days=rng.randrange(4))]),
                rng.choice([None, 0.0, -0.0, 1.5, 2.5]),
                rng.choice([None, 1, 2]),
            )
        )
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def expected_winners(df):
    """Plain Python: NULL first ascending, NULL last descending."""

    def place(r):
        def down(v):
            return (v is None, 0 if v is None else -(v.timestamp() if hasattr(v, "timestamp") else v))

        def up(v):
            return (v is not None, v if v is not None else 0)

        return (down(r["at"]), down(r["score"]), up(r["rank"]), r["id"])

    best = {}
    for r in df.collect():
        key = (r["k1"], r["k2"])
        if key not in best or place(r) < place(best[key]):
            best[key] = r
    return {r["id"] for r in best.values()}


def test_marking_matches_brute_force(spark):
    df = sample(spark)
    marked = mark_winners(df, ("k1", "k2"), ORDER)
    assert marked.count() == df.count()
    assert marked.columns == [*df.columns, "_kept"]
    assert {r["id"] for r in marked.where("_kept").collect()} == expected_winners(df)


def test_full_ties_leave_one_row(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 5), (2, 1), (None, 3), (None, 3)], "k int, o int")
    marked = mark_winners(df, ("k",), (("o", "asc"),))
    assert marked.count() == 6 and marked.where("_kept").count() == 3


def test_ties_of_different_rows_leave_one_row(spark):
    df = spark.createDataFrame([(1, 5, x) for x in "abcab"], "k int, o int, other string")
    marked = mark_winners(df, ("k",), (("o", "asc"),)).collect()
    assert sorted(r["other"] for r in marked) == list("aabbc") and sum(r["_kept"] for r in marked) == 1


def test_kept_and_dropped_cover_the_input(spark):
    df = sample(spark)
    kept, dropped = deduplicate(df, ("k1", "k2"), ORDER)
    ids = [r["id"] for r in kept.collect()] + [r["id"] for r in dropped.collect()]
    assert sorted(ids) == list(range(df.count()))
    assert {r["id"] for r in kept.collect()} == expected_winners(df)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = sample(spark)
    plan = keep_first(df, ("k1", "k2"), ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("tied", [False, True])
def test_a_hot_key_is_never_gathered(spark, tied):
    """One key, distinct or tied order: adaptive execution splits the join, no window sorts the key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        place = F.lit(1) if tied else F.col("id")
        rows = spark.range(0, 40_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, "x").otherwise(F.col("id").cast("string")).alias("k"),
            place.alias("o"),
            F.sha1(F.col("id").cast("string")).alias("payload"),
        )
        marked = mark_winners(rows, ("k",), (("o", "asc"),))
        counted = marked.groupBy("_kept").agg(F.count(F.lit(1)).alias("n"), F.max("payload"))
        assert {r["_kept"]: r["n"] for r in counted.collect()} == {True: 13_335, False: 26_665}
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in plan and "Window" not in plan


def test_marked_rows_can_be_written(spark, tmp_path):
    marked = mark_winners(sample(spark), ("k1", "k2"), ORDER)
    path = str(tmp_path / "marked")
    write_partitions(marked, path, by=("_kept",))
    assert spark.read.parquet(path).count() == 600


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_row_moves_where_no_key_repeats(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 5000).selectExpr("id AS k", "id % 7 AS o", "sha1(string(id)) AS payload").write.parquet(path)
    rows = spark.read.parquet(path).where("k >= 0").withColumn("more", F.lit("x"))
    marked = mark_winners(rows, ("k",), (("o", "asc"),))
    assert "Exchange" not in final_plan(marked) and marked.where("_kept").count() == 5000


def test_few_repeated_keys_are_broadcast_and_many_are_not(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 20_000).selectExpr("CASE WHEN id < 30 THEN id % 10 ELSE id END AS k", "id AS o").write.parquet(path)
    marked = mark_winners(spark.read.parquet(path), ("k",), (("o", "asc"),))
    plan = final_plan(marked)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert marked.where("NOT _kept").count() == 20
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        marked = mark_winners(spark.read.parquet(path), ("k",), (("o", "asc"),))
        assert "SortMergeJoin" in marked._jdf.queryExecution().executedPlan().toString()
        assert marked.where("NOT _kept").count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_repeated_keys_move_no_row(spark, tmp_path):
    """The winners' bits go to the rows, in two tables that are each below the limit."""
    path = str(tmp_path / "rows")
    spark.range(0, 40_000, 1, 4).selectExpr("id * 7 % 9000 AS k", "id * 7919 % 40009 AS o", "id").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        marked = mark_winners(spark.read.parquet(path), ("k",), (("o", "asc"),))
        plan = final_plan(marked)
        won = {r["id"] for r in marked.where("_kept").collect()}
        n = marked.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and final.count("BroadcastHashJoin") == 2
    assert n == 40_000 and won == set({i * 7 % 9000: i for i in sorted(range(40_000), key=lambda i: -(i * 7919 % 40009))}.values())


def test_millions_of_equal_rows_stay_spread(spark, tmp_path):
    path, out = str(tmp_path / "rows"), str(tmp_path / "marked")
    spark.range(0, 2_000_000, 1, 8).selectExpr("1 AS k", "5 AS o", "'same' AS payload").write.parquet(path)
    marked = mark_winners(spark.read.parquet(path), ("k",), (("o", "asc"),))
    marked.write.parquet(out)
    files = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.count_if("_kept").alias("won"))
    sizes = files.collect()
    assert sum(r["won"] for r in sizes) == 1 and sum(r["n"] for r in sizes) == 2_000_000
    assert len(sizes) >= 4 and max(r["n"] for r in sizes) <= 600_000


def test_an_unstable_plan_is_written_down_first(spark):
    rows = spark.range(0, 3000).selectExpr("id % 40 AS k", "rand() AS o", "id")
    marked = mark_winners(rows, ("k",), (("o", "asc"),)).collect()
    assert len(marked) == 3000 and sum(r["_kept"] for r in marked) == 40
