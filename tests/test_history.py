from __future__ import annotations

import datetime as dt
import random

import pytest

from conform.operators import history

D1, D2, D3 = (f"2024-01-0{i} 00:00:00" for i in (1, 2, 3))
F1 = [("k1", "a", None), ("k2", "b", "x"), ("k3", "c", "y")]
F2 = [("k1", "a", None), ("k2", "B", "x"), ("k4", "d", None)]
F3 = [("k1", "a", "n"), ("k2", "B", "x"), ("k3", "c", "y"), ("k4", "d", None)]


def day(n):
    return dt.datetime(2024, 1, n)


WANT = [
    ("k1", "a", "n", day(3), None), ("k1", "a", None, day(1), day(3)), ("k2", "B", "x", day(2), None),
    ("k2", "b", "x", day(1), day(2)), ("k3", "c", "y", day(1), None), ("k4", "d", None, day(2), None),
]


def run(spark, feeds, shuffle=None, **kw):
    kept, counts = None, []
    for feed, ts in feeds:
        feed = random.Random(shuffle).sample(feed, len(feed)) if shuffle is not None else feed
        df = spark.createDataFrame(feed, "k string, a string, b string")
        kept = history.scd2_check(kept, df, ["k"], ["a", "b"], ts, **kw)
        counts.append(kept.count())
    return kept, counts


@pytest.mark.parametrize("shuffle", [None, 5])
def test_three_feeds_and_a_replay(spark, rows, shuffle):
    kept, counts = run(spark, [(F1, D1), (F2, D2), (F3, D3), (F3, "2024-01-04 00:00:00")], shuffle)
    assert counts == [3, 5, 6, 6]
    assert rows(kept) == sorted(WANT, key=repr)


def test_close_missing(spark, rows):
    kept, _ = run(spark, [(F1, D1), (F2, D2), (F3, D3)], close_missing=True)
    k3 = [r[3:] for r in rows(kept) if r[0] == "k3"]
    assert k3 == sorted([(day(1), day(2)), (day(3), None)], key=repr)


def test_unchecked_columns_do_not_open_versions(spark, rows):
    one = spark.createDataFrame([("k", 1, "t1")], "k string, a int, load string")
    two = spark.createDataFrame([("k", 1, "t2")], "k string, a int, load string")
    kept = history.scd2_check(history.scd2_check(None, one, ["k"], ["a"], D1), two, ["k"], ["a"], D2)
    assert rows(kept) == [("k", 1, "t1", day(1), None)]


def test_a_null_key_is_a_key(spark):
    feed = [(None, "a", None)]
    _, counts = run(spark, [(feed, D1), (feed, D2)])
    assert counts == [1, 1]


def test_as_of_is_half_open(spark, rows):
    kept, _ = run(spark, [(F1, D1), (F2, D2)])
    assert [r[1] for r in rows(history.as_of(kept, D2)) if r[0] == "k2"] == ["B"]
    assert [r[1] for r in rows(history.as_of(kept, "2024-01-01 23:59:59")) if r[0] == "k2"] == ["b"]
    assert history.current(kept).count() == 4


def test_audit_columns(spark):
    kept, _ = run(spark, [(F1, D1)])
    r = history.audited(kept, ["k"]).where("k = 'k1'").first()
    import hashlib

    assert r["scd_id"] == hashlib.md5(b"k1|2024-01-01 00:00:00").hexdigest()
    assert r["updated_at"] == day(1)


def test_calendar(spark):
    days = history.date_dim(spark, "2008-01-01", "2020-01-01")
    assert days.count() == 4383
    first, last = days.orderBy("date_sk").first(), days.orderBy(days.date_sk.desc()).first()
    assert tuple(first) == (20080101, dt.date(2008, 1, 1), 2008, 1, 1, "Tuesday")
    assert last["full_date"] == dt.date(2019, 12, 31)


def test_scd1_is_case_and_space_sensitive(spark):
    df = spark.createDataFrame([("Acne",), ("acne",), ("Acne ",), ("Acne",), (None,)], "c string")
    dim = history.scd1_dim(df, ["c"], "sk")
    assert dim.count() == 3 and dim.columns == ["sk", "c"]
