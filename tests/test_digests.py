"""Hash trees against key sets and plain comparison."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import digests, reconcile
from conform.sources.buckets import BucketedTable
from conform.sources.lake import Lake

BITS = (4, 4)


@pytest.fixture
def copy(spark):
    return spark.range(2000).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("b")
    )


def test_one_changed_row_joins_one_leaf(copy):
    other = copy.withColumn("a", F.when(F.col("k") == 77, 100).otherwise(F.col("a")))
    row = digests.digest_reconcile(copy, other, ["k"], ["a", "b"], BITS).first()
    assert (row["leaves_differing"], row["keys_changed"], row["passed"]) == (1, 1, False)
    assert row["rows_compared"] < 4000 / 16 and row["left_rows"] == row["right_rows"] == row["keys_both"] == 2000
    found = digests.digest_differences(copy, other, ["k"], ["a", "b"], BITS).collect()
    assert [tuple(r) for r in found] == [(77, "changed", ["a"])]


def test_equal_copies_join_nothing(copy):
    row = digests.digest_reconcile(copy, copy.repartition(3), ["k"], ["a", "b"], BITS).first()
    assert row["passed"] and row["leaves_differing"] == 0 and row["rows_compared"] == 0


def test_counts_equal_those_of_the_key_sets(copy):
    other = copy.where("k % 10 <> 3").unionByName(copy.where("k < 20").withColumn("k", F.col("k") + 5000))
    other = other.withColumn("b", F.when(F.col("k") % 100 == 1, None).otherwise(F.col("b")))
    got = digests.digest_reconcile(copy, other, ["k"], ["a", "b"], BITS).first()
    want = reconcile.reconcile_keys(copy, other, ["k"]).first()
    for c in ("left_rows", "right_rows", "keys_both", "keys_left_only", "keys_right_only"):
        assert got[c] == want[c], c
    assert got["keys_changed"] == 20


def test_null_and_shifted_values_differ(spark):
    rows = lambda *r: spark.createDataFrame(r, "k string, a string, b string")
    left = rows((None, "x", None), ("1", "x", None), ("2", None, "y"), ("3", "z", "z"))
    right = rows((None, None, "x"), ("1", None, "x"), ("2", None, "y"), ("4", "z", "z"))
    got = {r["k"]: (r["change"], r["changed_cols"]) for r in digests.digest_differences(left, right, ["k"], ["a", "b"], BITS).collect()}
    assert got == {None: ("changed", ["a", "b"]), "1": ("changed", ["a", "b"]), "3": ("left_only", []), "4": ("right_only", [])}


def test_repeated_keys(spark):
    rows = lambda *r: spark.createDataFrame(r, "k long, a long")
    left = rows((1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1), (4, 1))
    right = rows((1, 2), (1, 1), (2, 1), (2, 3), (3, 1), (3, 1), (4, 1))
    got = sorted(tuple(r) for r in digests.digest_differences(left, right, ["k"], ["a"], BITS).collect())
    assert got == [(2, "repeated", []), (3, "repeated", []), (4, "repeated", [])]
    assert digests.digest_reconcile(left, right, ["k"], ["a"], BITS).first()["keys_changed"] == 3


def test_empty_sides(copy):
    nothing = copy.limit(0)
    row = digests.digest_reconcile(nothing, copy, ["k"], ["a", "b"], BITS).first()
    assert (row["left_rows"], row["keys_right_only"], row["keys_both"], row["passed"]) == (0, 2000, 0, False)
    assert digests.digest_reconcile(nothing, nothing, ["k"], ["a", "b"], BITS).first()["passed"]


def test_a_hot_key_does_not_break_the_sums(spark):
    hot = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    assert digests.digest_reconcile(hot, hot, ["k"], ["a"], BITS).first()["passed"]
    other = hot.withColumn("a", F.when(F.col("a") == 9, -1).otherwise(F.col("a")))
    assert digests.digest_reconcile(hot, other, ["k"], ["a"], BITS).first()["keys_changed"] == 1


def test_stored_trees_and_bucketed_copies_open_the_differing_folders_only(spark, tmp_path, copy):
    lake = Lake(spark, str(tmp_path))
    tables = [BucketedTable(lake, lake.silver(n), ["k"], bits=BITS[0]) for n in ("l", "r")]
    for t in tables:
        t.replace(copy)
    tables[1].upsert(spark.createDataFrame([(77, 100, "77")], "k long, a long, b string"))
    left, right = (t.read() for t in tables)
    trees = [digests.store_tree(x, lake.silver(n + "_digest"), ["k"], ["a", "b"], BITS) for x, n in ((left, "l"), (right, "r"))]
    leaves = digests.differing_leaves(*trees, BITS)
    assert leaves.count() == 1
    read = digests._suspected(left, ["k"], ["a", "b"], leaves, BITS)
    assert read.count() < 2000 / 16
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    row = digests.digest_reconcile(left, right, ["k"], ["a", "b"], BITS, *trees).first()
    assert (row["keys_changed"], row["leaves_differing"], row["keys_both"]) == (1, 1, 2000)
