"""Clustering on several columns at once: places on a curve that keeps rows near in every column.

A value's rank among quantiles of its column, found by a sketch, replaces the value, so skewed and differently
scaled columns weigh alike. The ranks give a place on a Hilbert curve, which goes from cell to neighbouring cell; rows
close on the curve are close in all columns, so row groups span a narrow range of each wherever they are cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8  # of a rank: 255 cut points a column
PREFIX = 7  # bytes of a string that are ordered, as they fit a long


def ordered(df: DataFrame, column: str) -> Column:
    """A number in the order of the column: itself, time as seconds, text by its first bytes, a boolean as 0 or 1."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    if isinstance(kind, T.StringType):
        head = F.substring(F.encode(c, "utf-8"), 1, PREFIX)
        return F.conv(F.rpad(F.hex(head), 2 * PREFIX, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return (c.cast("int") if isinstance(kind, T.BooleanType) else c).cast("double")
    raise ValueError(f"{column!r} is {kind.simpleString()}, which has no order to cluster by")


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Quantiles that cut each column into 2 ** ``bits`` ranges of about equal rows: one pass, one row to the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(ordered(df, c), shares, 4 << bits).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: list(row[f"_{i}"] or [0.0] * len(shares)) for i, c in enumerate(columns)}


def rank(df: DataFrame, column: str, cuts: Sequence[float]) -> Column:
    """How many cut points are below or at the value, by halving; NULL ranks as the smallest value."""
    points = F.array(*[F.lit(x) for x in cuts])
    value = F.coalesce(ordered(df, column), F.lit(float("-inf")))
    steps = F.array(*[F.lit(1 << b) for b in range((len(cuts) + 1).bit_length() - 2, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda r, s: F.when(F.get(points, r + s - 1) <= value, r + s).otherwise(r))


def curve(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, the highest first."""
    place = F.lit(0).cast("long")
    for i in range(bits):
        for j, r in enumerate(ranks):
            bit = F.call_function("shiftright", r, F.lit(i)).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.call_function("shiftleft", bit, F.lit(i * len(ranks) + j))
    return place


def hilbert(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """An array of as many numbers as ``ranks``, whose interleaved bits, the last number's first, are the place on a Hilbert curve.

    The curve jumps nowhere: a range of it that starts or ends beside a cell's edge goes on into a neighbouring cell. (Skilling's way:
    from the highest bit, axes are swapped and mirrored to undo each cell's turn; then the Gray code is taken.)
    """
    n = len(ranks)
    if n == 1:
        return F.array(*ranks)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("bit"), F.lit(i).alias("axis")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, step: Column) -> Column:
        lower, own, first = step["bit"] - 1, F.get(x, step["axis"]), F.get(x, F.lit(0))
        mirrored = own.bitwiseAND(step["bit"]) != 0
        swap = F.when(mirrored, F.lit(0)).otherwise(first.bitwiseXOR(own).bitwiseAND(lower))
        at_first = F.when(mirrored, lower).otherwise(swap)
        return F.transform(x, lambda v, i: v.bitwiseXOR(F.when(i == 0, at_first).when(i == step["axis"], swap).otherwise(F.lit(0))))

    def gray(x: Column) -> Column:
        coded = [F.get(x, F.lit(0))]
        for i in range(1, n):
            coded.append(coded[-1].bitwiseXOR(F.get(x, F.lit(i))))
        last, flip = coded[-1], F.lit(0)
        for b in range(1, bits):
            flip = flip.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        return F.transform(F.array(*reversed(coded)), lambda v: v.bitwiseXOR(flip))

    return F.aggregate(steps, F.array(*ranks), turn, gray)


def with_place(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS, cuts: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """``df`` with the row's place on the curve through ``columns`` (as many as fit 63 bits)."""
    if not columns or len(columns) * bits > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a place")
    cuts = cuts or cut_points(df, columns, bits)
    ranked = df.withColumns({f"{name}_{i}": rank(df, c, cuts[c]) for i, c in enumerate(columns)})
    turned = ranked.withColumn(f"{name}_", hilbert([F.col(f"{name}_{i}") for i in range(len(columns))], bits))
    ranks = [F.get(F.col(f"{name}_"), F.lit(i)) for i in range(len(columns))]
    return turned.withColumn(name, curve(ranks, bits)).drop(f"{name}_", *[f"{name}_{i}" for i in range(len(columns))])


def spans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column per file of a stored table: what a filter has to go by."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)
