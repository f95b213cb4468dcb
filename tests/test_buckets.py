"""Bucketed tables: what an upsert rewrites, conflicts, keys; and commits of two writers."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conform.sources.buckets import BucketedTable
from conform.sources.lake import CommitConflict, Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def table(lake):
    return BucketedTable(lake, lake.silver("t"), ["k"], bits=4)


def rows_of(spark, n, value="a"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def files(table):
    return {p: p.stat().st_mtime_ns for p in Path(table.path, "data").rglob("*.parquet")}


def got(table, **how):
    return sorted(((r["k"], r["v"]) for r in table.read(**how).collect()), key=repr)


def test_an_upsert_rewrites_the_touched_buckets_only(spark, table):
    table.replace(rows_of(spark, 500))
    before, at = files(table), table.folders()
    touched = table.upsert(spark.createDataFrame([(7, "new"), (1000, "more")], "k long, v string"))
    assert 1 <= len(touched) <= 2 and len(at) == 16
    assert {b for b, p in table.folders().items() if at.get(b) != p} == set(touched)
    assert {p: t for p, t in files(table).items() if p in before} == before
    want = sorted([(i, "new" if i == 7 else "a") for i in range(500)] + [(1000, "more")], key=repr)
    assert got(table) == want and got(table, version=1) == sorted([(i, "a") for i in range(500)], key=repr)
    assert len(table.read(buckets=touched).inputFiles()) < len(table.read().inputFiles())


def test_deletes_null_keys_and_new_columns_order(spark, table):
    table.replace(spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k long, v string"))
    table.upsert(spark.createDataFrame([("N", None), ("c", 3)], "v string, k long"), deleted=spark.createDataFrame([(2,), (99,)], "k long"))
    assert got(table) == sorted([(1, "a"), (None, "N"), (3, "c")], key=repr)
    assert table.upsert(rows_of(spark, 0)) == [] and table.version() == 2
    table.upsert(rows_of(spark, 0), deleted=spark.createDataFrame([(1,), (3,), (None,)], "k long"))
    assert table.version() == 3


def test_a_repeated_key_changes_nothing(spark, table):
    table.replace(rows_of(spark, 10))
    with pytest.raises(Exception, match="repeated key"):
        table.upsert(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"))
    assert got(table) == [(i, "a") for i in range(10)] and table.version() == 1


def test_an_unwritten_table_is_refused(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    with pytest.raises(FileNotFoundError):
        table.upsert(rows_of(spark, 1))


def test_of_two_upserts_on_one_state_the_second_is_refused(spark, table, monkeypatch):
    table.replace(rows_of(spark, 50))
    other = BucketedTable(table.lake, table.path, table.keys, table.bits)
    write = BucketedTable._write

    def meanwhile(self, df, version):
        monkeypatch.setattr(BucketedTable, "_write", write)
        other.upsert(spark.createDataFrame([(1, "other")], "k long, v string"))
        return write(self, df, version)

    monkeypatch.setattr(BucketedTable, "_write", meanwhile)
    with pytest.raises(CommitConflict):
        table.upsert(spark.createDataFrame([(2, "mine")], "k long, v string"))
    assert dict(got(table))[1] == "other" and dict(got(table))[2] == "a"


def test_two_writers_lose_no_publish(spark, lake):
    for run in ("a", "b"):
        lake.write_model(spark.range(1), lake.gold(run, "m"))
    failed = []

    def writer(run):
        try:
            for _ in range(5):
                lake.publish(run, ["m"])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=writer, args=(run,)) for run in ("a", "b")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    log = lake.all_commits(lake._path("gold_commits"))
    assert not failed and [r["seq"] for r in log] == list(range(1, 11))
    assert sorted(r["ref"] for r in log) == ["a"] * 5 + ["b"] * 5


def test_a_publish_that_expects_another_run_is_refused(spark, lake):
    for run in ("a", "b", "c"):
        lake.write_model(spark.range(1), lake.gold(run, "m"))
    lake.publish("a", ["m"])
    lake.publish("b", ["m"], expected="a")
    with pytest.raises(CommitConflict):
        lake.publish("c", ["m"], expected="a")
    assert lake.current_run() == "b"


def test_of_two_snapshot_updates_the_second_is_refused(spark, lake, monkeypatch):
    feed = lambda v: spark.createDataFrame([("1", v)], "k string, a string")
    args = (["k"], ["a"])
    lake.update_snapshot("s", feed("x"), *args, "2024-01-01")
    claim = Lake._claim

    def meanwhile(self, path, least):
        monkeypatch.setattr(Lake, "_claim", claim)
        lake.update_snapshot("s", feed("other"), *args, "2024-01-02")
        return claim(self, path, least)

    monkeypatch.setattr(Lake, "_claim", meanwhile)
    with pytest.raises(CommitConflict):
        lake.update_snapshot("s", feed("mine"), *args, "2024-01-03")
    assert sorted(r["a"] for r in lake.read_snapshot("s").collect()) == ["other", "x"]
    lake.update_snapshot("s", feed("mine"), *args, "2024-01-03")
    assert sorted(r["a"] for r in lake.read_snapshot("s").collect()) == ["mine", "other", "x"]


def test_a_commit_file_left_empty_blocks_nobody(spark, lake):
    lake.write_model(spark.range(1), lake.gold("a", "m"))
    lake.publish("a", ["m"])
    Path(lake._path("gold_commits"), f"{2:020d}.json").touch()
    lake.publish("a", ["m"])
    assert [r["seq"] for r in lake.all_commits(lake._path("gold_commits"))] == [1, 3] and lake.current_run() == "a"
