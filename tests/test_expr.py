from __future__ import annotations

import math

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapstrata.contracts.flights import BANDS
from snapstrata.functions import expr as X


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(column.alias("x")).first()["x"]


def test_band_labels_and_limits():
    assert BANDS.rows() == [
        ("0-3 days (last minute)", 1, 0, 3),
        ("4-7 days (short)", 2, 4, 7),
        ("8-15 days (medium)", 3, 8, 15),
        ("16-30 days (long)", 4, 16, 30),
        ("31+ days (advance)", 5, 31, None),
    ]


def test_bands_on_values(spark):
    days = spark.createDataFrame([(d,) for d in (0, 3, 4, 15, 16, 30, 31, 400, None)], "d int")
    got = days.select(X.lead_time_rank("d", BANDS), X.lead_time_label("d", BANDS)).collect()
    assert [r[0] for r in got] == [1, 1, 2, 3, 4, 4, 5, 5, 5]
    assert got[2][1] == "4-7 days (short)"


def test_safe_divide(spark):
    assert one(spark, X.safe_divide("a", "b"), a=10, b=4) == 2.5
    assert one(spark, X.safe_divide("a", "b"), a=10, b=0) is None
    assert one(spark, X.safe_divide(F.col("a"), F.lit(None).cast("int")), a=10) is None
    assert one(spark, X.percent("a", "b"), a=1, b=3) == 33.33


def test_null_parts_in_keys(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    skipping = df.select(X.surrogate_key(("x", "y", "z"))).distinct().count()
    marking = df.select(X.surrogate_key(("x", "y", "z"), null_token="<null>")).distinct().count()
    assert (skipping, marking) == (1, 2)
    assert df.select(X.strict_key("x", "y").alias("k")).where("k is null").count() == 1


def test_unordered_pair(spark):
    rows = [("A", "B"), ("B", "A"), (None, "A"), ("A", None)]
    df = spark.createDataFrame(rows, "l string, r string")
    got = [r[0] for r in df.select(X.unordered_pair("l", "r")).collect()]
    assert got == ["A<->B", "A<->B", None, None]


def test_label_code_and_casts(spark):
    codes = {"zero": 0, "one": 1}
    assert one(spark, X.label_code("s", codes), s="one") == 1
    assert one(spark, X.label_code("s", codes), s="many") is None
    assert one(spark, X.parse_as("s", "int"), s="12x") is None
    assert one(spark, X.parse_as("s", "date"), s="2024-02-30") is None
    assert one(spark, X.display_name("s"), s="Air_India") == "Air India"


@pytest.mark.parametrize("value", [1.005, 2.675, -1.005, 50.005, 0.125, -0.125, 1e15, 0.0])
def test_rounding_agrees_with_the_sql_engine(spark, value):
    want = duckdb.execute("SELECT round(CAST(? AS DOUBLE), 2)", [value]).fetchone()[0]
    assert one(spark, X.round_binary(F.col("v"), 2), v=value) == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=200))
def test_rounding_agrees_on_random_quotients(spark, values):
    pairs = [(i, float(v), float(i % 7 + 1)) for i, v in enumerate(values)]
    df = spark.createDataFrame(pairs, "i int, a double, b double")
    got = {r["i"]: r["x"] for r in df.select("i", X.safe_divide("a", "b").alias("x")).collect()}
    con = duckdb.connect()
    for i, a, b in pairs:
        want = con.execute("SELECT round(CAST(? AS DOUBLE) / CAST(? AS DOUBLE), 2)", [a, b])
        assert math.isclose(got[i], want.fetchone()[0], rel_tol=0, abs_tol=0)
