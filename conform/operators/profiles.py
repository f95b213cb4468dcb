"""Column profiles that merge: one stored row of sketches per column and load date.

A range of dates is profiled by merging the rows of its dates; the data behind them is not opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_DISTINCT = 14  # 2 ** 14 registers: 0.8 % standard error, 2.5 % in 99 of 100
QUANTILE_K = 400  # 0.7 % of rank
FREQUENT = 4096  # items tracked; a count is too high by rows / (0.75 * FREQUENT) at most
#: What the merged numbers may be off by, of the distinct values, of the rows and of the rows.
BOUNDS = {"distinct": 0.03, "rank": 0.01, "count": 4 / (3 * FREQUENT)}


def daily_profile(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """``load_date, column, rows, nulls, lowest, highest, values, ranks, items``: one row per date and column.

    ``values`` is a sketch of the distinct values, ``items`` one of the frequent ones (both of the values as text), ``ranks`` one of
    quantiles for numbers, NULL for others; ``lowest`` and ``highest`` are exact, for numbers. One scan; sketches are
    built in the tasks and merged, so a date of any size sends a few of them.
    """
    out = []
    for c in columns:
        number = isinstance(df.schema[c].dataType, T.NumericType)
        text, value = F.col(c).cast("string"), F.col(c).cast("double")
        none = F.lit(None)
        out.append(
            F.struct(
                F.lit(c).alias("column"),
                text.alias("text"),
                (value if number else none.cast("double")).alias("value"),
            )
        )
    cells = df.select(F.to_date(date).alias("load_date"), F.explode(F.array(*out)).alias("c")).select("load_date", "c.*")
    return cells.groupBy("load_date", "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("text").isNull()).alias("nulls"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.hll_sketch_agg("text", LG_DISTINCT).alias("values"),
        F.kll_sketch_agg_double("value", QUANTILE_K).alias("ranks"),
        F.expr(f"approx_top_k_accumulate(text, {FREQUENT})").alias("items"),
    )


def merged_profile(stored: DataFrame, first: str, last: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """``column, rows, nulls, lowest, highest, distinct, quantiles, frequent`` over the dates from ``first`` to ``last``.

    Rows without a date are part of no range. See :data:`BOUNDS` for how far the last three may be off.
    """
    inside = stored.where(F.col("load_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    merged = inside.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
        F.expr(f"approx_top_k_combine(items, {FREQUENT})").alias("items"),
    )
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select(
        "column", "rows", "nulls", "lowest", "highest",
        F.hll_sketch_estimate("values").alias("distinct"),
        F.when(F.col("lowest").isNotNull(), F.kll_sketch_get_quantile_double("ranks", wanted)).alias("quantiles"),
        F.expr(f"filter(approx_top_k_estimate(items, {top + 1}), x -> x.item is not null)").alias("frequent"),
    ).withColumn("frequent", F.slice("frequent", 1, top))


def within_bounds(profile: DataFrame, df: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, rows, nulls, lowest, highest, distinct_ok, quantiles_ok, frequent_ok``: a profile held against the rows it stands for."""
    parts = []
    for r in profile.select("column", "quantiles", "frequent").collect():  # one small row a column
        c = F.col(r["column"])
        checks = [F.lit(r["column"]).alias("column"), F.count_distinct(c).alias("exact")]
        ranks = [F.abs(F.count_if(c <= q) / F.count(c) - s) for q, s in zip(r["quantiles"] or [], quantiles, strict=False)]
        near = [F.coalesce(x <= BOUNDS["rank"] + F.count_if(c == q) / F.count(c), F.lit(True)) for x, q in zip(ranks, r["quantiles"] or [], strict=False)]
        counts = [F.abs(F.count_if(c.cast("string") == x["item"]) - x["count"]) <= BOUNDS["count"] * F.count(F.lit(1)) + 1 for x in r["frequent"]]
        parts.append(df.agg(*checks, reduce(lambda a, b: a & b, near, F.lit(True)).alias("quantiles_ok"), reduce(lambda a, b: a & b, counts, F.lit(True)).alias("frequent_ok")))
    exact = reduce(DataFrame.unionByName, parts)
    off = F.abs(F.col("distinct") - F.col("exact")) <= BOUNDS["distinct"] * F.col("exact") + 1
    return profile.join(exact, "column").select("column", "rows", "nulls", "lowest", "highest", off.alias("distinct_ok"), "quantiles_ok", "frequent_ok")
