"""Feeds in any order give the history of the feeds in order."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conform.operators import history, late

DAYS = [f"2024-01-0{i} 00:00:00" for i in range(1, 6)]
SCHEMA = "k string, a int, b string"


def in_order(spark, feeds, close_missing):
    out = None
    for day, rows in sorted(feeds.items()):
        out = history.scd2_check(out, spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], day, close_missing)
        out = spark.createDataFrame(out.collect(), out.schema)
    return out


def in_any_order(spark, feeds, order, close_missing):
    out, times = None, []
    for day in order:
        out = late.insert_feed(out, spark.createDataFrame(feeds[day], SCHEMA), ["k"], day, times, close_missing)
        out = spark.createDataFrame(out.collect(), out.schema)
        times.append(day)
    return out


def feeds_of(seed, days, keys):
    """Every key's values over the days: absent, or one of two."""
    rng = random.Random(seed)
    out = {d: [] for d in days}
    for i in range(keys):
        for d in days:
            value = rng.choice([None, 1, 2])
            if value is not None:
                out[d].append((None if i == 0 else f"k{i}", value, rng.choice(["x", None]) if seed % 2 else "x"))
    return out


@pytest.mark.parametrize("close_missing", [False, True])
@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_every_order_of_three_feeds_and_every_pattern(spark, rows, close_missing, order):
    days = DAYS[:3]
    feeds = {d: [] for d in days}
    for i, pattern in enumerate(itertools.product([None, 1, 2], repeat=3)):  # all 27 lives of a key
        for d, value in zip(days, pattern, strict=True):
            if value:
                feeds[d].append((f"k{i}", value, "x"))
    want = rows(in_order(spark, feeds, close_missing))
    got = in_any_order(spark, feeds, [days[i] for i in order], close_missing)
    assert rows(late.versions(got).select("k", "a", "b", "valid_from", "valid_to")) == want


@pytest.mark.parametrize("close_missing", [False, True])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_random_orders_of_five_feeds(spark, rows, close_missing, seed):
    feeds = feeds_of(seed, DAYS, 60)
    order = list(DAYS)
    random.Random(seed + 10).shuffle(order)
    want = rows(in_order(spark, feeds, close_missing))
    got = in_any_order(spark, feeds, order, close_missing)
    assert rows(late.versions(got).select("k", "a", "b", "valid_from", "valid_to")) == want


def test_refusals(spark):
    feed = spark.createDataFrame([("1", 1, "x")], SCHEMA)
    one = late.insert_feed(None, feed, ["k"], DAYS[0], [])
    with pytest.raises(ValueError, match="already"):
        late.insert_feed(one, feed, ["k"], DAYS[0], [DAYS[0]])
    with pytest.raises(ValueError, match="missing"):
        late.insert_feed(None, feed, ["k"], DAYS[1], [DAYS[0]])
    with pytest.raises(Exception, match="repeated key"):
        late.insert_feed(one, feed.union(feed), ["k"], DAYS[1], [DAYS[0]]).collect()


def test_an_empty_feed(spark, rows):
    feed = spark.createDataFrame([("1", 1, "x")], SCHEMA)
    one = late.insert_feed(None, feed, ["k"], DAYS[1], [])
    got = late.insert_feed(one, feed.limit(0), ["k"], DAYS[0], [DAYS[1]])
    assert rows(late.versions(got)) == rows(late.versions(one))
    closed = late.insert_feed(one, feed.limit(0), ["k"], DAYS[2], [DAYS[1]], close_missing=True)
    assert closed.where(F.col("valid_to").isNotNull()).count() == 1
