"""Joins that survive hot keys.

A side is broadcast in two cases only: its size is fixed by construction (a calendar),
or Spark itself finds it below ``autoBroadcastJoinThreshold``. Everything else is a
shuffle join whose hot keys :func:`salted_join` spreads. Keys that are merely warm are
left to Spark's adaptive skew join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.functions import text
from conform.operators import bitmaps
from conform.session import broadcastable, estimated_bytes

HOT_FACTOR = 2  # a key is hot when it holds more than this many average partitions
FINENESS = 4  # pieces per average partition a hot key is cut into
SKETCH = 8192  # items a sketch of frequent keys tracks at least
SKETCH_GROUPS = 64  # sketches that reach the last merge
MOST_BITS = 1 << 23  # of a bitmap of keys: 1 MB
ONE_TASK = 64 << 20  # bytes of a left side that one task can take whole, hot key and all


@dataclass(frozen=True)
class HotKeys:
    """Hashes of hot keys with the number of places each is spread to, and that of NULL keys."""

    ways: Mapping[int, int] = field(default_factory=dict)
    null_ways: int = 1


def _key_hash(keys: Sequence[str]) -> str:
    """SQL of the join key's hash; NULL when any part is NULL, as such a key matches nothing."""
    quoted = [f"`{k}`" for k in keys]
    known = " and ".join(f"{k} is not null" for k in quoted)
    return f"if({known}, xxhash64({', '.join(quoted)}), null)"


def hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """The keys that hold more than ``HOT_FACTOR`` average shuffle partitions.

    No more than partitions / ``HOT_FACTOR`` keys can, so that many hashes come to the driver at
    most. An action: one pass over the key columns. Each task keeps a sketch of a size that follows
    the number of partitions, so no key is shuffled; sketches merge in two steps. A miss or a hash
    collision costs speed only, never a row.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, partitions // HOT_FACTOR)
    sketch = min(1_000_000, max(SKETCH, 8 * most))  # the functions take a million at most
    top = (
        df.select(F.expr(_key_hash(keys)).alias("h"), F.expr(f"spark_partition_id() % {SKETCH_GROUPS} as g"))
        .groupBy("g")
        .agg(F.expr(f"approx_top_k_accumulate(h, {sketch}) as s"), F.expr("count(1) as n"))
        .groupBy(F.lit("all"))  # no row, rather than an empty sketch, where there is no input
        .agg(F.expr(f"approx_top_k_combine(s, {sketch}) as s"), F.expr("sum(n) as n"))
        .selectExpr(f"approx_top_k_estimate(s, {most}) as items", "n")
        .first()
    )
    if top is None:
        return HotKeys()
    rows = top["n"]
    hot = {
        i["item"]: math.ceil(i["count"] / rows * partitions * FINENESS)
        for i in top["items"]
        if i["count"] * partitions > rows * HOT_FACTOR
    }
    return HotKeys({h: n for h, n in hot.items() if h is not None}, hot.get(None, 1))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on equal keys, with the hot keys of ``left`` split.

    Rows of a hot key are spread by a hash of their content over as many places as its
    share asks for, and the matching right rows, which must be few per key, are copied to
    all of them. Other keys are not touched; NULL keys match nothing and are spread too.
    The salt depends on row content and on literals in the plan alone, so a task that runs
    again sends its rows to the same place. Without hot keys this is a plain join.

    ``hot`` is the result of :func:`hot_keys` on any table with the same keys; give it
    where ``left`` is costly to compute and its keys come from a stored table.
    ``salt_by`` are columns that tell rows apart (default: all). ``how`` is ``inner`` or
    ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports 'inner' and 'left', not {how!r}")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    same_types(left, right, {k: k for k in keys})
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot.ways and hot.null_ways == 1:
        return left.join(right, list(keys), how)

    content = f"xxhash64({', '.join(f'`{c}`' for c in (salt_by or left.columns))})"
    salt, places = "0L", "array(0L)"
    if hot.ways:
        listed = f"_h in ({', '.join(f'{h}L' for h in hot.ways)})"
        ways = "case _h " + " ".join(f"when {h}L then {n}L" for h, n in hot.ways.items()) + " end"
        salt = f"if({listed}, pmod({content}, {ways}), 0L)"
        places = f"if({listed}, sequence(0L, {ways} - 1), array(0L))"
    salt = f"if(_h is null, pmod({content}, {hot.null_ways}L), {salt})"

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("_h", F.expr(_key_hash(keys)))

    lhs = hashed(left).withColumn("_salt", F.expr(salt)).drop("_h")
    rhs = hashed(right).where("_h is not null").withColumn("_salt", F.explode(F.expr(places))).drop("_h")
    return lhs.join(rhs, [*keys, "_salt"], how).drop("_salt")


def needs_salt(left: DataFrame, right: DataFrame) -> bool:
    """Whether a join may need its hot keys split: not if either side is small."""
    return estimated_bytes(left) > ONE_TASK and not broadcastable(right)


def join_back(
    df: DataFrame, answers: DataFrame, keys: Sequence[str], salt_by: Sequence[str], keys_from: DataFrame
) -> DataFrame:
    """Left join of a table to answers found for its distinct keys."""
    if not needs_salt(df, answers):
        return df.join(answers, list(keys), "left")
    return salted_join(df, answers, keys, salt_by=salt_by, hot=hot_keys(keys_from, keys))


def same_types(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> None:
    """Keys of different types hash differently; let the caller say which cast is meant."""
    for a, b in on.items():
        x, y = left.schema[a].dataType, right.schema[b].dataType
        if x != y:
            raise ValueError(f"join key {a!r} is {x.simpleString()} but {b!r} is {y.simpleString()}")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    how: str = "left",
    size: str = "auto",
    keys_from: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add columns of a dimension to a fact.

    ``on`` maps fact columns to dimension columns; ``take`` maps dimension columns to
    the names they get. A miss leaves NULL and keeps the row (``how="left"``). The dimension has one row per key: a key
    that it repeats would multiply the fact, and fails the job instead. NULL keys match nothing and may repeat. ``unique`` says
    that the dimension is made unique by the plan that gives it, so that it need not be looked at.

    ``size`` says how the dimension is brought to the fact:
      * ``fixed``: small by construction (a calendar): broadcast, unless its size says otherwise; then as ``auto``.
      * ``auto``: left to Spark where the dimension can be broadcast or the fact is small
        enough for one task, by Spark's size estimates; else ``salted``.
      * ``salted``: shuffled, with the hot keys of the fact spread. They are looked for
        in ``keys_from``, a table with the same ``on`` columns that is cheaper to read
        than the fact (default: the fact), and rows are spread by ``salt_by``, columns
        that tell rows apart (default: all, which reads all).
    """
    if size not in ("fixed", "auto", "salted"):
        raise ValueError(f"size must be fixed, auto or salted, not {size!r}")
    same_types(fact, dim, on)
    side = dim.select(
        *[F.col(d).alias(f"_k{i}") for i, d in enumerate(on.values())],
        *[F.col(src).alias(dst) for src, dst in take.items()],
    )
    keyed = fact.withColumns({f"_k{i}": F.col(f) for i, f in enumerate(on)})
    names = [f"_k{i}" for i in range(len(on))]
    if not unique and size != "fixed":
        side = _one_per_key(side, names)
    if size == "fixed" and broadcastable(side):
        joined = keyed.join(F.broadcast(side), names, how)
    elif size != "salted" and not needs_salt(keyed, side):
        joined = keyed.join(side, names, how)
    else:
        hot = hot_keys(fact if keys_from is None else keys_from, list(on))
        joined = salted_join(keyed, side, names, how, salt_by=salt_by, hot=hot)
    return joined.select(*fact.columns, *take.values())


def _one_per_key(side: DataFrame, names: Sequence[str]) -> DataFrame:
    """``side`` with an error in place of the row of a key that it repeats."""
    known = side.where(" and ".join(f"{n} is not null" for n in names))
    taken = [c for c in side.columns if c not in names]
    doubled = F.raise_error(F.concat(F.lit("repeated key of a dimension: "), F.to_json(F.struct(*names))))
    counted = known.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in taken])
    return counted.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(doubled)).select(*names, *taken)


def reduced(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], bits: int | None = None) -> DataFrame:
    """The rows of a fact whose key a dimension may hold: a semi-join by a bitmap, before any shuffle.

    For an inner join to the few members of a dimension that a filter leaves. The bitmap has 16 bits a member,
    at most ``MOST_BITS``, and travels as a literal of the plan; about one row in 16 of the others passes too
    and finds no partner in the join. A dimension that would fill more than a quarter of the largest bitmap is not worth it, and the fact
    is returned as it is. An action: the dimension's keys are counted and hashed.
    """
    same_types(fact, dim, on)
    members = dim.select(F.expr(_key_hash(list(on.values()))).alias("h")).where("h is not null")
    if bits is None:
        wanted = 16 * members.count()
        if wanted > 4 * MOST_BITS:
            return fact
        bits = min(MOST_BITS, max(1 << 10, 1 << max(0, wanted - 1).bit_length()))
    held = bitmaps.bitmap(members, F.col("h"), bits)
    return fact.where(bitmaps.maybe_in(held, F.expr(_key_hash(list(on)))))


def name_map(dim: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """``(name_norm, key)`` with one key, the smallest, per normalised name.

    Many members share a name, so joining a fact to the dimension by name would
    multiply its rows. Empty names map to nothing. Both name columns are read in one
    scan, and the minimum is taken map-side before the shuffle.
    """
    forms = F.array_distinct(F.array(*[text.normalise(n) for n in names]))
    return (
        dim.select(F.col(key), F.explode(forms).alias("name_norm"))
        .where("name_norm is not null and name_norm != ''")
        .groupBy("name_norm")
        .agg(F.min(key).alias(key))
    )


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """``(fk, rows)``: foreign keys with no parent and how many rows carry each; NULL is no orphan.

    The child is reduced to one row per key first, so a hot key costs one row.
    """
    carried = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(pk).alias("_pk"))
    return carried.join(known, carried[fk] == F.col("_pk"), "left_anti")
