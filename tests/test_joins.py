from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a tenth have none, some keys have no partner."""
    fact = spark.range(30_000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
        .cast("int")
        .alias("k"),
    )
    dim = spark.range(400).select(F.col("id").cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    return fact, dim


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("copies", [1, 3])
def test_salted_join_equals_plain_join(spark, skewed, how, copies):
    fact, dim = skewed
    dim = dim.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    salted, plain = joins.salted_join(fact, dim, ["k"], how), fact.join(dim, "k", how)
    cols = sorted(plain.columns)
    assert salted.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert plain.select(cols).exceptAll(salted.select(cols)).count() == 0


def test_two_part_keys_and_nulls_on_both_sides(spark, rows):
    left = spark.createDataFrame([(1, "a", 10), (1, None, 11), (None, "a", 12)], "x int, y string, n int")
    right = spark.createDataFrame([(1, "a", "hit"), (1, None, "no"), (None, "a", "no")], "x int, y string, v string")
    got = rows(joins.salted_join(left, right, ["x", "y"]), "n", "v")
    assert got == [(10, "hit"), (11, None), (12, None)]


def test_hot_keys_are_few_and_found(spark, skewed):
    fact, _ = skewed
    found = joins.hot_keys(fact, ["k"])
    seven = spark.range(1).select(F.xxhash64(F.lit(7))).first()[0]
    # A third of the rows on 8 partitions, four pieces to a partition.
    assert found == joins.HotKeys({seven: 11}, 1)
    uniform = spark.range(10_000).withColumnRenamed("id", "k")
    assert joins.hot_keys(uniform, ["k"]) == joins.HotKeys()
    nulls = spark.range(900).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    assert joins.hot_keys(nulls, ["k"]).null_ways == 16
    assert joins.hot_keys(uniform.limit(0), ["k"]) == joins.HotKeys()


def test_no_hot_key_means_a_plain_join(spark):
    a, b = spark.range(100), spark.range(50).withColumn("v", F.lit(1))
    plan = joins.salted_join(a, b, ["id"])._jdf.queryExecution().analyzed().toString()
    assert "_salt" not in plan


def test_keys_of_different_types_are_refused(spark):
    a = spark.range(3).select(F.col("id").cast("int").alias("k"))
    b = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="join key 'k' is int but 'k' is bigint"):
        joins.salted_join(a, b, ["k"])
    with pytest.raises(ValueError, match="bigint"):
        joins.lookup(a, b, {"k": "k"}, {"v": "v"})


def test_hot_key_is_spread_over_tasks(spark, skewed):
    """With broadcasts off, no task of the join holds the hot key's third of the rows."""
    fact, dim = skewed
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        assert largest(fact.join(dim, "k", "left")) > 30_000 / 3
        assert largest(joins.salted_join(fact, dim, ["k"])) < 30_000 / 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_salted_join_refuses_what_it_cannot_do(spark, skewed):
    fact, dim = skewed
    with pytest.raises(ValueError, match="full"):
        joins.salted_join(fact, dim, ["k"], "full")
    with pytest.raises(ValueError, match="row"):
        joins.salted_join(fact, dim.withColumnRenamed("v", "row"), ["k"])


@pytest.mark.parametrize("size", ["fixed", "auto", "salted"])
def test_lookup_keeps_every_row(spark, rows, size):
    fact = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "A!"), (None, "never")], "c string, name string")
    got = joins.lookup(fact, dim, {"code": "c"}, {"name": "label"}, size=size)
    assert got.columns == ["id", "code", "label"]
    assert rows(got) == [(1, "a", "A!"), (2, "zz", None), (3, None, None)]


def test_name_map(spark, rows):
    members = spark.createDataFrame(
        [("s2", "Advil PM", "Ibuprofen"), ("s1", "ADVIL-pm", None), ("s3", "--", ""), ("s0", None, "ibuprofen!")],
        "sk string, brand string, generic string",
    )
    got = rows(joins.name_map(members, "sk", ["brand", "generic"]), "name_norm", "sk")
    assert got == [("advilpm", "s1"), ("ibuprofen", "s0")]


def test_orphan_keys(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (None,)], "pk int")
    assert rows(joins.orphan_keys(child, "fk", parent, "pk")) == [(2, 2)]


def test_auto_lookup_salts_what_is_too_large_to_broadcast(spark, skewed, monkeypatch):
    fact, dim = skewed
    plain = joins.lookup(fact, dim, {"k": "k"}, {"v": "v"})
    assert "_salt" not in plain._jdf.queryExecution().analyzed().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        small = joins.lookup(fact, dim, {"k": "k"}, {"v": "v"}, salt_by=["row"])
        assert "_salt" not in small._jdf.queryExecution().analyzed().toString()
        monkeypatch.setattr(joins, "ONE_TASK", 10)
        salted = joins.lookup(fact, dim, {"k": "k"}, {"v": "v"}, salt_by=["row"])
        assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
        assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("size", ["auto", "salted"])
def test_a_doubled_dimension_key_fails_instead_of_multiplying(spark, size):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "x"), (None, "y")], "id long, v string")
    with pytest.raises(Exception, match="repeated key of a dimension"):
        joins.lookup(fact, dim, {"k": "id"}, {"v": "v"}, size=size).collect()
    once = dim.where("v <> 'c' or v is null")
    got = sorted(((r["k"], r["v"]) for r in joins.lookup(fact, once, {"k": "id"}, {"v": "v"}, size=size).collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "b"), (None, None)], key=repr)


def test_a_reduced_fact_keeps_all_hits_and_few_others(spark):
    fact = spark.range(50_000).select((F.col("id") % 10_000).alias("k"), "id")
    dim = spark.range(10_000).where("id % 50 = 0").select(F.col("id").alias("key"))
    few = joins.reduced(fact, dim, {"k": "key"})
    assert few.where("k % 50 = 0").count() == 1_000
    assert few.count() < 1_000 + 49_000 / 8
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    assert joins.reduced(fact, dim.limit(0), {"k": "key"}).count() == 0


def test_a_large_dimension_reduces_nothing(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_BITS", 1 << 10)
    fact, dim = spark.range(2_000).withColumnRenamed("id", "k"), spark.range(1_000).withColumnRenamed("id", "key")
    assert joins.reduced(fact, dim, {"k": "key"}).count() == 2_000
