"""Type-2 history from feeds that arrive in any order.

A version is not enough to take in an earlier feed: whether a later feed saw the same values again, or did not hold the key,
decides where the version between them ends. So a history that takes late feeds also
keeps when each version was last seen and, for feeds in between, when its key was missing. With the list of feed
times that is all there is to know, and a feed with an earlier time changes only versions
around that time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.operators.history import FROM, TO

SEEN, MISSED = "last_seen", "missed"


def first_feed(feed: DataFrame, at: str | dt.datetime) -> DataFrame:
    """The history of one feed."""
    t = F.lit(at).cast("timestamp")
    return feed.withColumns(
        {FROM: t, TO: F.lit(None).cast("timestamp"), SEEN: t, MISSED: F.array().cast("array<timestamp>")}
    )


def insert_feed(
    history: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    at: str | dt.datetime,
    times: Sequence[str | dt.datetime],
    close_missing: bool = False,
) -> DataFrame:
    """The history with one more feed, as if all feeds had come in the order of their times.

    ``times`` are those of the feeds in the history, one per run; ``at`` is not among them. All columns but the keys are
    compared, NULL equals NULL. Per key only the version valid at ``at`` and the next one take part, found by one window over versions
    that end later, whose partial rank leaves two rows a key; all others pass through untouched:

    * the values at ``at`` differ from the version's: it ends there, the new values hold up to the version's next
      sighting, and from then on the version goes on as a row of its own; without a later sighting they hold up to the next version, and become
      part of it if it has the same values;
    * no version is valid at ``at``: one opens, up to the next feed that says otherwise;
    * the values are the same, or the key is missing: the version's sightings are noted, and with ``close_missing`` a version
      ends where its key is missing.

    The feed is unique per key, and so is the result per key and moment; a repeated key fails the job. A time that was taken in already
    is refused, as a feed can only be corrected by building the history again.
    """
    known = sorted({_moment(t) for t in times})
    now = _moment(at)
    if history is None:
        if known:
            raise ValueError("a history of earlier feeds is missing")
        return first_feed(feed, now)
    if now in known:
        raise ValueError(f"the feed of {now} is in the history already")
    cols = [c for c in feed.columns if c not in keys]
    shape = [*keys, *cols, FROM, TO, SEEN, MISSED]
    t, never = F.lit(now).cast("timestamp"), F.lit(None).cast("timestamp")
    log = F.array(*[F.lit(x).cast("timestamp") for x in known])

    history = history.select(*shape)
    later = F.col(TO).isNull() | (F.col(TO) > t)
    near = history.where(later).withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(FROM)))
    # The first two versions that end later: the one valid now, if it has begun, and the next.
    first = near.where("_place <= 2").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(FROM, *[c for c in shape if c not in (FROM, *keys)]))).alias("_v"))
    far = near.where("_place > 2").drop("_place")

    doubled = F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys))))
    fresh = feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*cols)).alias("_x"))
    fresh = fresh.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.when(F.col("_n") == 1, F.col("_x")).otherwise(doubled).alias("_x"))
    same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    both = first.join(fresh, same_key, "full_outer")
    begun = F.get("_v", F.lit(0))[FROM] < t
    both = both.select(
        *[F.coalesce(k, f"_k_{k}").alias(k) for k in keys],
        "_x",
        F.when(begun, F.get("_v", F.lit(0))).alias("v"),
        F.when(begun, F.get("_v", F.lit(1))).otherwise(F.get("_v", F.lit(0))).alias("w"),
        F.when(~begun, F.get("_v", F.lit(1))).alias("rest"),
    )
    v, w, x = F.col("v"), F.col("w"), F.col("_x")
    here, there = v.isNotNull(), x.isNotNull()

    def equal(side: Column) -> Column:
        out = side.isNotNull()
        for c in cols:
            out = out & side[c].eqNullSafe(x[c])
        return out

    def between(low: Column, high: Column) -> Column:
        """Feed times after ``low`` and before ``high``; all later ones for a NULL ``high``."""
        return F.filter(log, lambda m: (m > low) & (high.isNull() | (m < high)))

    def row(values: Column, start: Column, end: Column, seen: Column, missed: Column) -> Column:
        return F.struct(
            *[values[c].alias(c) for c in cols], start.alias(FROM), end.alias(TO), seen.alias(SEEN), missed.alias(MISSED)
        )

    def kept(side: Column) -> Column:
        return row(side, side[FROM], side[TO], side[SEEN], side[MISSED])

    def only(rows: Column) -> Column:
        return F.filter(rows, lambda r: r.isNotNull())

    # Sightings of the version now valid, before and after.
    sightings = F.filter(log, lambda m: (m >= v[FROM]) & (m <= v[SEEN]) & ~F.array_contains(v[MISSED], m))
    before = F.array_max(F.filter(sightings, lambda m: m < t))
    after = F.array_min(F.filter(sightings, lambda m: m > t))
    missed_before = F.filter(v[MISSED], lambda m: m < before)
    missed_after = F.filter(v[MISSED], lambda m: m > after)
    left = row(v, v[FROM], t, before, missed_before)
    right = F.when(after.isNotNull(), row(v, after, v[TO], v[SEEN], missed_after))
    gap_free = F.array().cast("array<timestamp>")
    next_feed = F.array_min(between(t, never))
    if close_missing:
        # A version was seen in every feed from its start to its last sighting, and ends with the feed after.
        joined = equal(w) & (w[FROM] == next_feed)
        new_end = F.when(after.isNotNull(), after).otherwise(next_feed)
        opened = F.when(~joined, row(x, t, new_end, t, gap_free))
        grown = F.when(joined, row(w, t, w[TO], w[SEEN], gap_free)).when(w.isNotNull(), kept(w))
        unseen = F.when(t < v[SEEN], F.array(left, right, kept(w))).otherwise(F.array(row(v, v[FROM], t, v[SEEN], v[MISSED]), kept(w)))
        noted = row(v, v[FROM], v[TO], F.greatest(v[SEEN], t), v[MISSED])
    else:
        joined = equal(w) & after.isNull()
        new_end = F.coalesce(after, v[TO], w[FROM])
        opened = F.when(~joined, row(x, t, new_end, t, gap_free))
        missed = F.concat(between(t, w[FROM]), w[MISSED])
        grown = F.when(joined, row(w, t, w[TO], w[SEEN], missed)).when(w.isNotNull(), kept(w))
        absent = F.when(t < v[SEEN], F.array_sort(F.array_append(v[MISSED], t))).otherwise(v[MISSED])
        unseen = F.array(row(v, v[FROM], v[TO], v[SEEN], absent), kept(w))
        later_seen = F.concat(v[MISSED], between(v[SEEN], t))
        noted = F.when(t < v[SEEN], kept(v)).otherwise(row(v, v[FROM], v[TO], t, later_seen))
    rows = (
        F.when(~there & ~here, F.array(kept(w)))
        .when(~there, unseen)
        .when(~here, F.array(opened, grown))
        .when(equal(v), F.array(noted, F.when(w.isNotNull(), kept(w))))
        .otherwise(F.array(left, opened, right, grown))
    )
    others = F.when(F.col("rest").isNotNull(), kept(F.col("rest")))
    changed = both.select(*keys, F.explode(only(F.concat(rows, F.array(others)))).alias("r")).select(*keys, "r.*")
    changed = changed.where(F.col(FROM).isNotNull())
    untouched = history.where(~later)
    return untouched.unionByName(changed.select(*shape)).unionByName(far.select(*shape))


def versions(history: DataFrame) -> DataFrame:
    """The history as :func:`~conform.operators.history.scd2_check` gives it, without the notes."""
    return history.drop(SEEN, MISSED)


def _moment(t: str | dt.datetime) -> dt.datetime:
    return t if isinstance(t, dt.datetime) else dt.datetime.fromisoformat(t)
