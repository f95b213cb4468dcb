from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.functions.keys import surrogate_key
from conform.operators import reconcile


def test_layers(spark, rows):
    ten, twenty, nine, none = (spark.range(n) for n in (10, 20, 9, 0))
    report = reconcile.reconcile_layers(
        [
            reconcile.Hop("double", ten, twenty, factor=2),
            reconcile.Hop("plus", ten, twenty, offset=10),
            reconcile.Hop("not_equal", ten, nine),
            reconcile.Hop("lossy", ten, nine, "drop", tolerance=0.2),
            reconcile.Hop("too_lossy", ten, nine, "drop", tolerance=0.05),
            reconcile.Hop("grew", ten, twenty, "drop"),
            reconcile.Hop("both_empty", none, none, "drop"),
            reconcile.Hop("from_nothing", none, ten, "drop"),
        ]
    )
    assert dict(rows(report, "check", "passed")) == {
        "double": True, "plus": True, "not_equal": False, "lossy": True, "too_lossy": False,
        "grew": False, "both_empty": True, "from_nothing": False,
    }
    with pytest.raises(ValueError, match="about"):
        reconcile.reconcile_layers([reconcile.Hop("x", ten, ten, "about")])


def test_key_sets(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (3,), (None,), (None,)], "k int")
    r = reconcile.reconcile_keys(left, right, ["k"]).first()
    assert tuple(r) == (4, 4, 2, 1, 1, False)
    assert reconcile.reconcile_keys(left, left, ["k"]).first()["passed"]
    empty = left.limit(0)
    assert tuple(reconcile.reconcile_keys(empty, empty, ["k"]).first()) == (0, 0, 0, 0, 0, True)
    sides = {tuple(r) for r in reconcile.one_sided_keys(left, right, ["k"]).collect()}
    assert sides == {(2, "left"), (3, "right")}


def test_feed_delta(spark, rows):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "a", None), (2, "B", None), (4, "d", "z")], "k int, a string, b string")
    got = rows(reconcile.feed_delta(old, new, ["k"], ["a", "b"]))
    assert got == [(2, "changed", ["a", "b"]), (3, "withdrawn", []), (4, "added", [])]
    assert reconcile.feed_delta(old, old, ["k"], ["a", "b"]).count() == 0


@pytest.mark.parametrize("rows_wanted", [1, 3000])
def test_keys_of_other_types_are_refused_whatever_the_size(spark, rows_wanted):
    start = spark.range(rows_wanted).selectExpr("cast(id as string) as sk")
    layer = reconcile.Layer("raw", spark.range(5), F.col("id"), "sk", ["id"])
    with pytest.raises(ValueError, match="string"):
        reconcile.trace_back(start, [layer])


def test_a_repeated_feed_key_fails_instead_of_multiplying(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, a string")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, a string")
    with pytest.raises(Exception, match="repeated key"):
        reconcile.feed_delta(old, new, ["k"], ["a"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        reconcile.feed_delta(old, new.where("a <> 'b'").union(old.where("k is null")), ["k"], ["a"]).collect()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_trace_back(spark, rows, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    raw = spark.createDataFrame([(1, "f1"), (2, "f2")], "id int, source_file string")
    fact = raw.select(surrogate_key("id").alias("sk"))
    lost = fact.unionByName(spark.createDataFrame([("gone",)], "sk string"))
    layers = [reconcile.Layer("raw", raw, surrogate_key("id"), "sk", ["id", "source_file"])]
    try:
        got = rows(reconcile.trace_back(lost, layers), "id", "source_file")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, "f1"), (2, "f2"), (None, None)]
