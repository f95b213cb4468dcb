from __future__ import annotations

import random

import pytest

from conform.operators import reshape

SCHEMA = "k string, d string, a array<string>, n string"
ROWS = [
    ("k1", "20200101", ["x"], "b"), ("k1", "20200101", ["x"], "a"), ("k1", None, ["x"], "z"),
    ("k2", "20190101", ["a; b"], None), ("k2", "20190101", ["a", "b"], None),
    ("k3", None, None, None), ("k3", None, None, "q"),
]
ORDER = [("d", "desc"), ("a", "asc"), ("n", "asc")]


def test_latest_row_and_tie_break(spark, rows):
    got = rows(reshape.dedupe_latest(spark.createDataFrame(ROWS, SCHEMA), ["k"], ORDER))
    assert got == [
        ("k1", "20200101", ["x"], "a"), ("k2", "20190101", ["a", "b"], None), ("k3", None, None, "q"),
    ]


def test_input_order_does_not_matter(spark, rows):
    want = rows(reshape.dedupe_latest(spark.createDataFrame(ROWS, SCHEMA), ["k"], ORDER))
    for seed in range(3):
        mixed = random.Random(seed).sample(ROWS, len(ROWS))
        df = spark.createDataFrame(mixed, SCHEMA).repartition(3 + seed)
        assert rows(reshape.dedupe_latest(df, ["k"], ORDER)) == want


def test_order_must_cover_all_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError, match="missing: \\['n'\\]"):
        reshape.dedupe_latest(df, ["k"], ORDER[:2])
    with pytest.raises(ValueError, match="'up'"):
        reshape.dedupe_latest(df, ["k"], [("d", "up"), *ORDER[1:]])


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = reshape.dedupe_latest(df, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_unpivot_keeps_null_cells(spark, rows):
    wide = spark.createDataFrame([(1, -2.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    got = rows(reshape.unpivot_clamp(wide, ["id"], ["a", "b"], "code", "v"))
    assert got == [(1, "a", 0.0), (1, "b", None), (2, "a", 3.0), (2, "b", 4.0)]


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(reshape.union_named(a, b)) == [(1, "x"), (2, "y")]


def test_scrub_and_flag(spark):
    values = ["Acne", "74</span> users found this", None, "a < b", "a < b > c"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [tuple(r) for r in reshape.scrub_and_flag(df, "c", "<[^>]+>", "tag").collect()]
    assert got == [
        ("Acne", False, None), (None, True, "tag"), (None, False, None),
        ("a < b", False, None), (None, True, "tag"),
    ]


def test_flatten(spark, rows):
    df = spark.createDataFrame([(["p", "q"], ["r", "s"]), ([], [])], "a array<string>, b array<string>")
    assert rows(reshape.flatten(df, joins=["a"], firsts=["b"])) == [("", None), ("p; q", "r")]


def test_shape_profile_counts_nulls(spark, rows):
    df = spark.createDataFrame([("<b>",), ("12",), (None,)], "c string")
    got = rows(reshape.shape_profile(df, "c", {"tag": "<[^>]+>", "digits": "^[0-9]+$"}))
    assert got == [("digits", 1, 3), ("null", 1, 3), ("tag", 1, 3)]
