"""Reconciliation between layers, copies and feeds, and tracing rows back to their source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.operators.history import pair_by_key
from conform.operators.joins import needs_salt, salted_join, same_types
from conform.session import stored


@dataclass(frozen=True)
class Hop:
    """One step between layers and what the row counts on its two ends must satisfy.

    ``equal``: ``downstream = upstream * factor + offset``.
    ``drop``: at most ``tolerance`` of the rows are lost, and none are added.
    """

    name: str
    upstream: DataFrame
    downstream: DataFrame
    rule: str = "equal"
    factor: int = 1
    offset: int = 0
    tolerance: float = 0.05


def reconcile_layers(hops: Sequence[Hop]) -> DataFrame:
    """``check, upstream_rows, downstream_rows, drop_rate, passed``, one row per hop."""
    counts = []
    for i, hop in enumerate(hops):
        for side, df in (("up", hop.upstream), ("down", hop.downstream)):
            counts.append(
                df.agg(F.lit(i).alias("_i"), F.lit(side).alias("_side"), F.count(F.lit(1)).alias("_n"))
            )
    wide = (
        reduce(DataFrame.unionByName, counts)
        .groupBy("_i")
        .agg(
            F.max(F.when(F.col("_side") == "up", F.col("_n"))).alias("upstream_rows"),
            F.max(F.when(F.col("_side") == "down", F.col("_n"))).alias("downstream_rows"),
        )
    )
    up, down = F.col("upstream_rows"), F.col("downstream_rows")
    drop = F.when(up > 0, 1 - down / up)
    passed, name = F.lit(False), F.lit(None).cast("string")
    for i, hop in enumerate(hops):
        if hop.rule == "equal":
            holds = down == up * hop.factor + hop.offset
        elif hop.rule == "drop":
            holds = F.coalesce((drop >= 0) & (drop <= hop.tolerance), down == 0)
        else:
            raise ValueError(f"rule must be equal or drop, not {hop.rule!r}")
        this = F.col("_i") == i
        passed, name = F.when(this, holds).otherwise(passed), F.when(this, hop.name).otherwise(name)
    return wide.select(
        name.alias("check"),
        "upstream_rows",
        "downstream_rows",
        drop.alias("drop_rate"),
        passed.alias("passed"),
    )


def reconcile_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row counts, distinct keys on both sides or on one only, and whether the copies agree.

    Keys are counted per task before the shuffle and never leave the executors, so a
    key repeated on a third of the rows costs one row per task.
    """
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    out = per_key.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") > 0)).alias("keys_both"),
        F.count_if(F.col("_r") == 0).alias("keys_left_only"),
        F.count_if(F.col("_l") == 0).alias("keys_right_only"),
    )
    return out.withColumn(
        "passed",
        (F.col("left_rows") == F.col("right_rows"))
        & (F.col("keys_left_only") == 0)
        & (F.col("keys_right_only") == 0),
    )


def one_sided_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys on one side only, with the side: the work list behind :func:`reconcile_keys`."""
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = tagged.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = F.when(F.col("_r") == 0, "left").otherwise("right")
    return per_key.where("_l + _r = 1").select(*keys, side.alias("only_in"))


def feed_delta(
    old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """``key.., change, changed_cols``: keys added, withdrawn or changed between two feeds.

    Both feeds are unique per key; NULL equals NULL.
    """
    changed = F.filter(
        F.array(
            *[F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in cols]
        ),
        lambda c: c.isNotNull(),
    )
    change = (
        F.when(F.col("l").isNull(), F.lit("added"))
        .when(F.col("r").isNull(), F.lit("withdrawn"))
        .when(F.size(changed) > 0, F.lit("changed"))
    )
    nothing = F.array().cast("array<string>")
    return (
        pair_by_key(old, new, keys)
        .select(
            *[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in keys],
            change.alias("change"),
            F.when(change == "changed", changed).otherwise(nothing).alias("changed_cols"),
        )
        .where("change is not null")
    )


@dataclass(frozen=True)
class Layer:
    """A layer on the way back to the source.

    ``key`` recomputes, from the layer's own columns, the key its upper neighbour
    carries as ``upper_key``. Hash keys cannot be reversed, but they can be recomputed.
    """

    name: str
    df: DataFrame
    key: Column
    upper_key: str
    keep: Sequence[str]


def trace_back(rows: DataFrame, layers: Sequence[Layer]) -> DataFrame:
    """Follow a set of rows down through the layers; each hop adds the lower layer's ``keep`` columns.

    A row whose source is gone shows NULLs rather than vanishing. The start rows and each hop's
    result are stored once in the shared scratch folder, so no hop repeats an earlier one, and each
    layer is cut to the keys that the hop before it asks for. Those keys are stored too: Spark
    broadcasts them where their real size allows it and shuffles otherwise, hop by hop.
    Keys of different types are refused whatever the size.
    """
    out = stored(rows, "trace")
    for layer in layers:
        lower = layer.df.select(layer.key.alias("_trace"), *layer.keep)
        keyed = out.withColumn("_trace", F.col(layer.upper_key))
        same_types(keyed, lower, {"_trace": "_trace"})
        asked = stored(keyed.where("_trace is not null").select("_trace").distinct(), "trace-keys")
        found = stored(lower.join(asked, "_trace", "left_semi"), "trace-found")
        joined = salted_join(keyed, found, ["_trace"]) if needs_salt(keyed, found) else keyed.join(found, "_trace", "left")
        out = stored(joined.drop("_trace"), "trace")
    return out
