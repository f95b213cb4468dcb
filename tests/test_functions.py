from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.errors import DateTimeException, PySparkException
from pyspark.sql import functions as F

from conform.functions import dates, keys, text
from conform.operators import reshape


def one(spark, column, **values):
    names = {k: "string" for k in values}
    schema = ", ".join(f"{k} {t}" for k, t in names.items()) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


def test_normalise(spark):
    assert one(spark, text.normalise("c"), c="  Advil PM-50 ") == "advilpm50"


def test_join_and_first_item(spark):
    df = spark.createDataFrame(
        [(["a", None, "b"],), ([],), (None,), (["x"],)], "a array<string>"
    ).select(text.join_items("a").alias("j"), text.first_item("a").alias("f"))
    assert [tuple(r) for r in df.collect()] == [("a; b", "a"), ("", None), (None, None), ("x", "x")]


@pytest.mark.parametrize(
    "value,want",
    [
        ("20-May-12", dt.date(2012, 5, 20)),
        ("1-Jan-08", dt.date(2008, 1, 1)),
        ("20-MAY-12", dt.date(2012, 5, 20)),
        ("01-Jan-69", dt.date(1969, 1, 1)),
        ("29-Feb-72", dt.date(1972, 2, 29)),
        ("01-Jan-75", dt.date(1975, 1, 1)),
        ("31-Dec-68", dt.date(2068, 12, 31)),
        (None, None),
    ],
)
def test_short_dates(spark, value, want):
    assert one(spark, dates.parse_day_mon_yy("c"), c=value) == want


def test_compact_dates(spark):
    assert one(spark, dates.parse_compact("c"), c="20140102") == dt.date(2014, 1, 2)
    with pytest.raises((DateTimeException, PySparkException)):
        one(spark, dates.parse_compact("c"), c="2012")
    assert one(spark, dates.parse_compact("c", strict=False), c="2012") is None
    flag = dates.unparsed("c", dates.parse_compact("c", strict=False))
    assert one(spark, flag, c="2012") is True
    assert one(spark, flag, c=None) is False


@pytest.mark.parametrize(
    "values,want",
    [
        ({"a": "2014-01-02", "b": "M01AB"}, "2363708cad28b03624eba0d4177fee36"),
        ({"a": "k1", "b": "2024-01-01 00:00:00"}, "e7d2cf0bc3f90f94fddcebd583ac832f"),
        ({"a": None}, "f14cc5cdce0420f4a5a6b6d9d7b85f39"),
    ],
)
def test_surrogate_key(spark, values, want):
    assert one(spark, keys.surrogate_key(*values), **values) == want


def test_key_of_typed_columns(spark):
    day = F.lit("2014-01-02").cast("date")
    assert one(spark, keys.surrogate_key(day, F.lit("M01AB"))) == "2363708cad28b03624eba0d4177fee36"
    moment = F.lit("2024-01-01").cast("timestamp")
    assert one(spark, keys.surrogate_key(F.lit("k1"), moment)) == "e7d2cf0bc3f90f94fddcebd583ac832f"
    assert one(spark, keys.date_key(day)) == 20140102
    assert one(spark, dates.weekday_name(F.lit("2008-01-01").cast("date"))) == "Tuesday"


def test_clamp(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (float("nan"),), (2.0,)], "x double")
    got = [r[0] for r in df.select(reshape.clamp("x")).collect()]
    assert got[0] == 0.0 and got[1] is None and math.isnan(got[2]) and got[3] == 2.0


def test_combination_flag(spark):
    names = [("A and B",), ("A WITH B",), ("a/b",), ("sand",), (None,)]
    df = spark.createDataFrame(names, "n string").select(text.is_combination("n"))
    assert [r[0] for r in df.collect()] == [True, True, True, False, None]


@pytest.mark.parametrize(
    "haystack,needle,want",
    [("abc", "a_c", True), ("abc", "b", True), ("abc", "", True), ("abc", "x%c", False),
     ("a%c", "%", True), ("a\\b", "\\", True), ("ab", "\\", False)],
)
def test_like_containing(spark, haystack, needle, want):
    assert one(spark, text.like_containing(F.col("a"), F.col("b")), a=haystack, b=needle) is want


def test_whole_word(spark):
    word = text.whole_word(F.col("a"), F.col("b"))
    assert one(spark, word, a="loratadine 10 mg", b="loratadine") is True
    assert one(spark, word, a="loratadinex", b="loratadine") is False


def test_a_recursion_goes_as_deep_as_the_dates(spark):
    from conform.plans.functions import months_with_orders

    orders = spark.createDataFrame([(1, "1990-01-15"), (2, "2010-12-31"), (3, "2010-12-01")], "o_orderkey long, o_orderdate string")
    orders = orders.selectExpr("o_orderkey", "cast(o_orderdate as timestamp) as o_orderdate")
    got = {str(r["month_start"]): r["orders"] for r in months_with_orders(spark, orders).collect()}
    assert len(got) == 252 and got["1990-01-01"] == 1 and got["2010-12-01"] == 2 and sum(got.values()) == 3
    same = months_with_orders(spark, orders.where("o_orderkey = 1")).collect()
    assert [r["orders"] for r in same] == [1]
