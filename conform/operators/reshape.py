"""Row and column reshaping for the cleaned tier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from conform.functions import text
from conform.functions.keys import as_column

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc"); NULLs always last


def clamp(c: str | Column, floor: float = 0.0) -> Column:
    """Raise values below the floor to it. NULL stays NULL and NaN stays NaN."""
    value = as_column(c)
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def unpivot(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide to long in one pass; NULL cells are kept, so rows multiply by ``len(cols)`` exactly."""
    return df.unpivot(list(ids), list(cols), name, value)


def unpivot_clamp(
    df: DataFrame,
    ids: Sequence[str],
    cols: Sequence[str],
    name: str,
    value: str,
    floor: float = 0.0,
) -> DataFrame:
    return unpivot(df, ids, cols, name, value).withColumn(value, clamp(value, floor))


def union_named(*parts: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Stack by column name, so that a changed column order in one file cannot shift values."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=allow_missing)
    return out


def _order_columns(df: DataFrame, order: Order) -> list[Column]:
    keys: list[Column] = []
    for name, direction in order:
        if direction not in ("asc", "desc"):
            raise ValueError(f"order of {name!r} must be 'asc' or 'desc', not {direction!r}")
        exprs = [F.col(name)]
        if isinstance(df.schema[name].dataType, T.ArrayType):
            # The joined text decides first; the array itself splits ['a; b'] from ['a', 'b'].
            exprs.insert(0, text.join_items(name))
        keys += [e.desc_nulls_last() if direction == "desc" else e.asc_nulls_last() for e in exprs]
    return keys


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Keep the first row per key under an order that names every other column.

    An order that leaves a column out could pick different winners on two runs over
    the same rows, and so write false history; it is refused.

    Filtering on the rank lets Spark drop all but one row per key *before* the
    shuffle (a partial WindowGroupLimit), so a key holding a third of the table
    sends one row per input task, not a third of the table, to one reducer.
    """
    missing = set(df.columns) - set(keys) - {name for name, _ in order}
    if missing:
        raise ValueError(f"order must cover every column; missing: {sorted(missing)}")
    w = Window.partitionBy(*keys).orderBy(*_order_columns(df, order))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def flatten(
    df: DataFrame, joins: Sequence[str] = (), firsts: Sequence[str] = (), sep: str = "; "
) -> DataFrame:
    """Turn array columns into strings: ``joins`` keep every item, ``firsts`` only the first."""
    exprs: dict[str, Column] = {c: text.join_items(c, sep) for c in joins}
    exprs |= {c: text.first_item(c) for c in firsts}
    return df.withColumns(exprs)


def scrub_and_flag(
    df: DataFrame,
    column: str,
    pattern: str,
    reason: str,
    flag: str = "dq_flag",
    reason_column: str = "dq_reason",
) -> DataFrame:
    """Null a value that matches the pattern, keep its row, and say so in two columns.

    A NULL input was missing, not bad: its flag is false and its reason NULL.
    """
    bad = F.coalesce(F.col(column).rlike(pattern), F.lit(False))
    return (
        df.withColumn(flag, bad)
        .withColumn(reason_column, F.when(F.col(flag), F.lit(reason)))
        .withColumn(column, F.when(~F.col(flag), F.col(column)))
    )


def shape_profile(df: DataFrame, column: str, shapes: Mapping[str, str]) -> DataFrame:
    """How many values match each named pattern, in one aggregate over the table.

    Run it before writing a scrub rule. One row per shape, plus ``null``.
    """
    c = F.col(column)
    counts = [F.count_if(c.rlike(p)).alias(f"_{i}") for i, p in enumerate(shapes.values())]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(c.isNull()).alias("_null"), *counts)
    rows = [
        F.struct(
            F.lit(shape).alias("shape"), F.col(f"_{i}").alias("matching"), F.col("_rows").alias("total")
        )
        for i, shape in enumerate(shapes)
    ]
    rows.append(
        F.struct(F.lit("null").alias("shape"), F.col("_null").alias("matching"), F.col("_rows").alias("total"))
    )
    return one.select(F.inline(F.array(*rows)))
