"""Hash trees over tables: where two copies differ, without joining what agrees.

Rows fall into leaf buckets by the hash of their key. A leaf's digest is the number of its rows, a sum and
an exclusive or of two row hashes; a bucket further up adds up its children. Two copies
are compared from the top, only children of buckets that differ are looked at, and only rows of
leaves that differ are read again and joined. A digest has a fixed size, so a copy can keep it
beside its data (:func:`store_tree`) and need not be read for a comparison at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.session import stored

BITS = (6, 5, 5)  # of each level: 64 buckets at the top, 65,536 leaves
_MASK = (1 << 31) - 1  # of a row hash that is summed: a leaf of 2^32 rows stays within a long
_WRAP = 1 << 40  # sums are kept modulo this, so that they stay within a long further up
DIGEST = ("rows", "total", "parity")


def _hashed(cols: Sequence[str], seed: int) -> Column:
    """64-bit hash of some columns in which a NULL is a value like any other."""
    parts: list[Column] = [F.lit(seed)]
    for c in cols:
        parts += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*parts)


def key_bucket(keys: Sequence[str], bits: int) -> Column:
    """The first ``bits`` of the key's hash: buckets of fewer bits hold whole buckets of more."""
    return F.shiftrightunsigned(_hashed(keys, 0), 64 - bits)


def _digest(cols: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        (F.sum(_hashed(cols, 1).bitwiseAND(F.lit(_MASK))) % _WRAP).alias("total"),
        F.bit_xor(_hashed(cols, 2)).alias("parity"),
    ]


def tree(df: DataFrame, keys: Sequence[str], cols: Sequence[str], bits: Sequence[int] = BITS) -> DataFrame:
    """``level, bucket, rows, total, parity``: the digests of all buckets, level 1 at the top.

    One pass over the key and the compared columns; a task sends a row a leaf at most, so a key or leaf with a third of
    the rows costs one row per task. Empty buckets have no row.
    """
    leaves = df.groupBy(key_bucket(keys, sum(bits)).alias("bucket")).agg(*_digest([*keys, *cols]))
    level = stored(leaves, "digest-leaves")
    levels = [level.withColumn("level", F.lit(len(bits)))]
    for depth in range(len(bits) - 1, 0, -1):
        parent = F.shiftrightunsigned("bucket", bits[depth]).alias("bucket")
        level = level.groupBy(parent).agg(
            F.sum("rows").alias("rows"), (F.sum("total") % _WRAP).alias("total"), F.bit_xor("parity").alias("parity")
        )
        levels.append(level.withColumn("level", F.lit(depth)))
    return reduce(DataFrame.unionByName, reversed(levels)).select("level", "bucket", *DIGEST)


def store_tree(df: DataFrame, path: str, keys: Sequence[str], cols: Sequence[str], bits: Sequence[int] = BITS) -> DataFrame:
    """Write the digests of a table beside it, a folder a level; :func:`differing_leaves` takes them in place of the table's."""
    tree(df, keys, cols, bits).repartition("level").sortWithinPartitions("bucket").write.mode("overwrite").partitionBy("level").parquet(path)
    return read_tree(df.sparkSession, path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bucket long, rows long, total long, parity long, level int").parquet(path).select("level", "bucket", *DIGEST)


def differing_leaves(left: DataFrame, right: DataFrame, bits: Sequence[int] = BITS) -> DataFrame:
    """``bucket, left_rows, right_rows`` of the leaves whose digests differ, found level by level from the top.

    Each level is a join of at most 2^bits rows, stored; the one below is read for children of what differed alone.
    """
    suspects: DataFrame | None = None
    for depth in range(1, len(bits) + 1):
        a, b = (t.where(F.col("level") == depth).drop("level") for t in (left, right))
        if suspects is not None:
            child = F.shiftrightunsigned("bucket", bits[depth - 1])
            up = F.broadcast(suspects.select(F.col("bucket").alias("_up")))  # 2^bits rows at most
            a, b = (t.join(up, child == F.col("_up"), "left_semi") for t in (a, b))
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in DIGEST]
        both = a.alias("l").join(b.alias("r"), F.col("l.bucket") == F.col("r.bucket"), "full_outer")
        differ = both.where(~reduce(Column.__and__, same)).select(
            F.coalesce("l.bucket", "r.bucket").alias("bucket"),
            F.coalesce("l.rows", F.lit(0)).cast("long").alias("left_rows"),
            F.coalesce("r.rows", F.lit(0)).cast("long").alias("right_rows"),
        )
        suspects = stored(differ, "digest-differ")
    return suspects


def _suspected(df: DataFrame, keys: Sequence[str], cols: Sequence[str], leaves: DataFrame, bits: Sequence[int]) -> DataFrame:
    """The rows of the differing leaves; of a bucketed table only the folders that hold any."""
    if "bucket" in df.columns and "bucket" not in [*keys, *cols]:
        tops = leaves.select(F.shiftrightunsigned("bucket", sum(bits[1:])).alias("b")).distinct().collect()  # 2^bits[0] at most
        df = df.where(F.col("bucket").isin([r["b"] for r in tops]))
    wanted = F.broadcast(leaves.select(F.col("bucket").alias("_leaf")))  # 2^bits rows of one number at most
    return df.select(*keys, *cols).join(wanted, key_bucket(keys, sum(bits)) == F.col("_leaf"), "left_semi")


def _per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str], side: str) -> DataFrame:
    """One row per key: its digest and, where it has a single row, that row."""
    row = F.first(F.struct(*keys, *cols)).alias("row")
    return df.groupBy(*keys).agg(*_digest([*keys, *cols]), row).select(F.struct("row", *DIGEST).alias(side))


def digest_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    bits: Sequence[int] = BITS,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """``key.., change, changed_cols``: keys on one side only, with other values, or repeated with other rows.

    ``change`` is ``left_only``, ``right_only``, ``changed`` (one row on both sides, which differ in
    ``changed_cols``) or ``repeated`` (several rows on a side, and not the same on both). NULL equals NULL, as key and as value.
    ``leaves`` come from :func:`differing_leaves`; without them both trees are built. A table with a column ``bucket``, such
    as :class:`~conform.sources.buckets.BucketedTable` gives with as many bits as the first level, is read in the folders that differ only.
    """
    if leaves is None:
        leaves = differing_leaves(tree(left, keys, cols, bits), tree(right, keys, cols, bits), bits)
    a = _per_key(_suspected(left, keys, cols, leaves, bits), keys, cols, "l")
    b = _per_key(_suspected(right, keys, cols, leaves, bits), keys, cols, "r")
    on = [F.col(f"l.row.{k}").eqNullSafe(F.col(f"r.row.{k}")) for k in keys]
    changed = F.array_compact(F.array(*[F.when(~F.col(f"l.row.{c}").eqNullSafe(F.col(f"r.row.{c}")), F.lit(c)) for c in cols]))
    same = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in DIGEST])
    change = (
        F.when(F.col("l").isNull(), F.lit("right_only"))
        .when(F.col("r").isNull(), F.lit("left_only"))
        .when((F.col("l.rows") == 1) & (F.col("r.rows") == 1), F.when(F.size(changed) > 0, F.lit("changed")))
        .when(~same, F.lit("repeated"))
    )
    nothing = F.array().cast("array<string>")
    return (
        a.join(b, reduce(Column.__and__, on), "full_outer")
        .select(
            *[F.coalesce(f"l.row.{k}", f"r.row.{k}").alias(k) for k in keys],
            change.alias("change"),
            F.when(change == "changed", changed).otherwise(nothing).alias("changed_cols"),
        )
        .where("change is not null")
    )


def digest_reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    bits: Sequence[int] = BITS,
    left_tree: DataFrame | None = None,
    right_tree: DataFrame | None = None,
) -> DataFrame:
    """One row: row counts, keys on both sides or one, keys with other rows, what was read again, and whether the copies agree.

    The counts are those of :func:`~conform.operators.reconcile.reconcile_keys` where keys are unique (in leaves that agree a row counts
    as a key), plus ``keys_changed``. ``leaves_differing`` and ``rows_compared`` say how much was joined. A stored tree stands in for the
    pass over its table.
    """
    a = tree(left, keys, cols, bits) if left_tree is None else left_tree
    b = tree(right, keys, cols, bits) if right_tree is None else right_tree
    leaves = differing_leaves(a, b, bits)
    found = digest_differences(left, right, keys, cols, bits, leaves)
    counts = found.agg(
        F.count_if(F.col("change") == "left_only").alias("keys_left_only"),
        F.count_if(F.col("change") == "right_only").alias("keys_right_only"),
        F.count_if(F.col("change").isin("changed", "repeated")).alias("keys_changed"),
    )
    zero = F.lit(0).cast("long")
    top = lambda t, name: t.where("level = 1").agg(F.coalesce(F.sum("rows"), zero).alias(name))
    again = leaves.agg(
        F.count(F.lit(1)).alias("leaves_differing"),
        F.coalesce(F.sum(F.col("left_rows") + F.col("right_rows")), zero).alias("rows_compared"),
        F.coalesce(F.sum("left_rows"), zero).alias("_left"),
    )
    in_both = _suspected(left, keys, cols, leaves, bits).select(*keys).distinct().agg(F.count(F.lit(1)).alias("_keys"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    parts = [one(x) for x in (top(a, "left_rows"), top(b, "right_rows"), counts, again, in_both)]
    row = reduce(lambda x, y: x.join(F.broadcast(y), "_one"), parts)  # one row each
    both = F.col("left_rows") - F.col("_left") + F.col("_keys") - F.col("keys_left_only")
    return row.select(
        "left_rows", "right_rows", both.alias("keys_both"), "keys_left_only", "keys_right_only", "keys_changed",
        "leaves_differing", "rows_compared",
        (F.col("keys_left_only") + F.col("keys_right_only") + F.col("keys_changed") == 0).alias("passed"),
    )
