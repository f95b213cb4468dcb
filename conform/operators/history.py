"""History keeping: type-2 snapshots by value comparison, type-1 and type-0 dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import dates, keys as k
from conform.session import stored

FROM, TO = "valid_from", "valid_to"
MOST_DAYS = 100_000  # of a calendar that is small by construction: 270 years


def differs(left: str, right: str, cols: Sequence[str]) -> Column:
    """True when any column differs between two struct columns; NULL equals NULL."""
    out = F.lit(False)
    for c in cols:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def pair_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two tables that are unique per key, as structs ``l`` and ``r``.

    NULL is a key like any other, so running the same feed twice adds nothing. A key that a
    side repeats fails the job, as it would multiply rows; so no key can be hot.
    """

    def one_per_key(df: DataFrame, side: str) -> DataFrame:
        doubled = F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys))))
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))
        return counted.select(F.when(F.col("_n") == 1, F.col("_row")).otherwise(doubled).alias(side))

    a, b = one_per_key(left, "l"), one_per_key(right, "r")
    cond = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
    return a.join(b, cond, "full_outer")


def merge_open(
    open_rows: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    snapshot_ts: str | dt.datetime,
    close_missing: bool = False,
) -> DataFrame:
    """Merge a feed into the open versions; only these take part, never the closed ones.

    The result holds the open versions after the merge and the versions closed by it
    (``valid_to = snapshot_ts``). One join, one pass: a changed key yields its closed
    and its new version from the same joined row. The feed must be unique per key.
    """
    at = F.lit(snapshot_ts).cast("timestamp")
    cols = feed.columns
    schema_cols = [*cols, FROM, TO]
    types = {f.name: f.dataType for f in feed.schema.fields}

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").cast(types[c]).alias(c) for c in cols],
            start.cast("timestamp").alias(FROM),
            end.cast("timestamp").alias(TO),
        )

    never = F.lit(None).cast("timestamp")
    kept = version("l", F.col(f"l.{FROM}"), never)
    closed = version("l", F.col(f"l.{FROM}"), at)
    fresh = version("r", at, never)
    gone = F.array(closed) if close_missing else F.array(kept)
    rows = (
        F.when(F.col("l").isNull(), F.array(fresh))
        .when(F.col("r").isNull(), gone)
        .when(differs("l", "r", check_cols), F.array(closed, fresh))
        .otherwise(F.array(kept))
    )
    return pair_by_key(open_rows, feed, keys).select(F.inline(rows)).select(*schema_cols)


def first_snapshot(feed: DataFrame, snapshot_ts: str | dt.datetime) -> DataFrame:
    return feed.withColumns(
        {FROM: F.lit(snapshot_ts).cast("timestamp"), TO: F.lit(None).cast("timestamp")}
    )


def scd2_check(
    history: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    snapshot_ts: str | dt.datetime,
    close_missing: bool = False,
) -> DataFrame:
    """History after one feed, comparing the check columns (NULL-safe).

    * no history: every row opens at ``snapshot_ts``;
    * new key: a row opens;
    * a check column differs: the open row closes at ``snapshot_ts`` and a new one opens;
    * nothing differs: the row stays as it is, also in columns that are not checked;
    * key missing from the feed: stays open, or closes with ``close_missing=True``.

    ``snapshot_ts`` is an argument and never the clock, so a rerun gives the same rows.
    """
    if history is None:
        return first_snapshot(feed, snapshot_ts)
    closed = history.where(F.col(TO).isNotNull())
    merged = merge_open(
        history.where(F.col(TO).isNull()), feed, keys, check_cols, snapshot_ts, close_missing
    )
    return closed.select(*merged.columns).unionByName(merged)


def as_of(history: DataFrame, ts: str | dt.datetime | Column) -> DataFrame:
    """The versions valid at a moment: from inclusive, to exclusive."""
    at = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    return history.where((F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at)))


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col(TO).isNull())


def audited(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the version id (MD5 of key and start) and the time the version was written."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*keys, FROM]]
    return history.withColumns({"scd_id": F.md5(F.concat_ws("|", *parts)), "updated_at": F.col(FROM)})


def scd1_dim(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Distinct non-NULL values with a hash key; case and spaces are significant."""
    kept = df.select(*cols).dropna("any", subset=list(cols)).distinct()
    return kept.select(k.surrogate_key(*cols).alias(key), *cols)


def date_dim(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"),
        F.date_sub(F.lit(end).cast("date"), 1).alias("last"),
    )
    return _calendar(bounds)


def date_dim_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a column; no row if it has none.

    An action: the two dates are read first, so that the size is known. A range beyond ``MOST_DAYS``, as one mistyped year makes it, is
    stored, and its real size decides how it is joined.
    """
    day, spark = F.to_date(column), df.sparkSession
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if ends["first"] is None:
        return _calendar(spark.range(0).select(F.current_date().alias("first"), F.current_date().alias("last")))
    bounds = spark.range(1).select(F.lit(ends["first"]).alias("first"), F.lit(ends["last"]).alias("last"))
    days = _calendar(bounds)
    return stored(days, "calendar") if (ends["last"] - ends["first"]).days > MOST_DAYS else days


def _calendar(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return days.select(
        k.date_key("full_date").alias("date_sk"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        dates.weekday_name("full_date").alias("weekday_name"),
    )


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows replaced by changes with the same key, plus the new ones.

    For tables without history. Both sides are unique per key.
    """
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(changes)
