"""Clustering on several columns, and profiles that merge."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import curve, profiles
from conform.sources.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def opened(lake, stored, column, value):
    files = curve.spans(stored, [column]).collect()
    return sum(r[f"lo_{column}"] <= value <= r[f"hi_{column}"] for r in files), len(files)


def test_a_filter_on_either_column_opens_few_files(spark, lake):
    df = spark.range(40_000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.exp(F.rand(3) * 10).alias("skewed"),
        F.concat(F.lit("name "), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("string")).alias("s"),
    )
    stored = lake.write_on_curve(df, lake.gold("r", "t"), ["a", "skewed"], files=64)
    assert stored.count() == 40_000 and stored.columns == df.columns
    for column, value in (("a", 500), ("skewed", 100.0)):
        hit, files = opened(lake, stored, column, value)
        assert files == 64 and hit <= 20  # 8 of 64 if cells and files met exactly
    plain = lake.write_clustered(df, lake.gold("r", "p"), ["a", "skewed"], files=64)
    assert opened(lake, plain, "skewed", 100.0)[0] > 50  # sorted by the first column, the second opens nearly all


def test_nulls_types_and_a_hot_combination(spark, lake):
    df = spark.range(8_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("s"),
        F.when(F.col("id") % 5 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int"))).alias("d"),
        (F.col("id") % 2 == 0).alias("b"), F.lit(1).alias("one"),
    )
    stored = lake.write_on_curve(df, lake.gold("r", "t"), ["s", "d", "b"], files=8)
    assert stored.exceptAll(df).isEmpty() and stored.count() == 8_000
    hot = lake.write_on_curve(df, lake.gold("r", "h"), ["one"], files=8)
    sizes = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 2_500  # one value, shared by tasks
    assert lake.write_on_curve(df.limit(0), lake.gold("r", "e"), ["s", "d"]).count() == 0
    with pytest.raises(ValueError, match="no order"):
        curve.cut_points(df.withColumn("arr", F.array("one")), ["arr"])


def test_ranks_follow_the_order_of_values(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("ab",), ("b",), ("é",), ("日",)], "s string")
    cuts = curve.cut_points(df, ["s"], 3)["s"]
    ranks = [r["r"] for r in df.select(curve.rank(df, "s", cuts).alias("r")).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 0 and ranks[-1] > 3


def test_bits_are_interleaved(spark):
    row = spark.range(1).select(curve.curve([F.lit(0b101), F.lit(0b011)], 3).alias("c")).first()
    assert row["c"] == 0b011011  # from the top: b2 a2, b1 a1, b0 a0


def test_neighbours_on_the_curve_are_neighbouring_cells(spark):
    for n, bits in ((1, 3), (2, 3), (3, 2)):
        ranks = [F.floor(F.col("id") / (1 << i * bits)).cast("int") % (1 << bits) for i in range(n)]
        cells = spark.range(1 << n * bits).select(*[r.alias(f"r{i}") for i, r in enumerate(ranks)])
        turned = cells.withColumn("h", curve.hilbert([F.col(f"r{i}") for i in range(n)], bits))
        walk = [tuple(r)[:n] for r in turned.withColumn("place", curve.curve([F.get("h", F.lit(i)) for i in range(n)], bits)).drop("h").sort("place").collect()]
        assert len(set(walk)) == 1 << n * bits
        assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in zip(walk, walk[1:]))


@pytest.mark.parametrize("most", [48_000, 43_000, 45_000])
def test_the_middle_opens_under_half_wherever_files_are_cut(spark, lake, most):
    ids = spark.range(most).select((F.col("id") % 6_011).alias("id"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2_000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)).alias("b"))
    placed = curve.with_place(ids, ["a", "b"], "place").sort("place", "id").collect()
    middle = {c: sorted(r[c] for r in placed)[len(placed) // 2] for c in ("a", "b")}
    for shift in (0.2, 0.4, 0.6, 0.8):  # files that do not meet the cells of the curve
        edges = [0, *[int(len(placed) * (i + shift) / 16) for i in range(15)], len(placed)]
        files = [placed[a:b] for a, b in zip(edges, edges[1:])]
        for c in ("a", "b"):
            assert sum(min(r[c] for r in f) <= middle[c] <= max(r[c] for r in f) for f in files) * 2 < len(files)


DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", None]


def test_any_range_is_profiled_from_stored_rows_alone(spark, lake):
    df = spark.range(60_000).select(
        F.get(F.array(*[F.lit(d) for d in DAYS]), (F.col("id") % 4).cast("int")).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("n"), F.when(F.col("id") % 10 > 0, F.lit(0.5)).otherwise(F.rand(1)).alias("x"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), (F.col("id") % 3).cast("string"))).alias("s"), F.lit(None).cast("int").alias("gone"),
    )
    df = lake.write_model(df, lake.silver("data"))
    stored = lake.write_model(profiles.daily_profile(df, "day", ["n", "x", "s", "gone"]), lake.silver("profile"))
    assert stored.count() == 16
    for first, last in (("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-03"), ("2024-01-01", "2024-01-31")):
        merged = profiles.merged_profile(stored, first, last)
        assert all("profile" in f for f in merged.inputFiles())
        inside = df.where(F.col("day").between(first, last))
        checked = profiles.within_bounds(merged, inside).collect()
        assert len(checked) == 4 and all(r["distinct_ok"] and r["quantiles_ok"] and r["frequent_ok"] for r in checked)
        exact = inside.agg(F.count("*"), F.count_if(F.col("s").isNull()), F.min("n"), F.max("n")).first()
        rows = {r["column"]: r for r in checked}
        assert rows["n"]["rows"] == exact[0] and rows["s"]["nulls"] == exact[1] and (rows["n"]["lowest"], rows["n"]["highest"]) == (exact[2], exact[3])
        assert rows["gone"]["nulls"] == rows["gone"]["rows"] and rows["gone"]["lowest"] is None
    assert profiles.merged_profile(stored, "2030-01-01", "2030-01-02").collect() == []
