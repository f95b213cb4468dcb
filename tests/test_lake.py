from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conform.plans import mart
from conform.sources import readers
from conform.sources.lake import Lake, PublishError, snapshot_schema


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_csv_with_quotes_commas_and_newlines(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "uniqueID,drugName,condition,review,rating,date,usefulCount\n"
        '1,"A","x","he said ""hi"", ok\nline2",9,20-May-12,27\n'
    )
    df = mart.read_feed(spark, "drug_reviews", str(tmp_path / "r.csv"))
    assert df.count() == 1
    assert df.first()["review"] == 'he said "hi", ok\nline2'


def test_csv_month_first_dates(spark, tmp_path):
    (tmp_path / "d.csv").write_text("d,n\n1/2/2014,3\n")
    df = readers.read_csv(spark, str(tmp_path / "d.csv"), "d date, n bigint", date_format="M/d/yyyy")
    assert tuple(df.first()) == (dt.date(2014, 1, 2), 3)


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "d.csv").write_text("n,d\n3,1/2/2014\n")
    df = readers.read_csv(spark, str(tmp_path / "d.csv"), "d string, n string")
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_json_array_keeps_nested_fields(spark, tmp_path, rows):
    feed = [{"product_ndc": "1-1", "pharm_class": ["a", "b"], "route": ["ORAL"]}, {"product_ndc": "1-2"}]
    (tmp_path / "n.json").write_text(json.dumps(feed))
    df = mart.read_feed(spark, "ndc_directory", str(tmp_path / "n.json"))
    assert rows(df, "product_ndc", "pharm_class", "route") == [
        ("1-1", ["a", "b"], ["ORAL"]), ("1-2", None, None),
    ]


def test_a_date_is_replaced_and_others_stay(spark, lake, rows):
    path = lake.bronze("s", "t")
    one, two = (spark.createDataFrame([(i,)], "v int") for i in (1, 2))
    lake.write_date(one, path, "2024-01-01")
    lake.write_date(two, path, "2024-01-02")
    lake.write_date(two, path, "2024-01-01")
    lake.write_date(two, path, "2024-01-01")
    got = rows(spark.read.parquet(path))
    assert got == [(2, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))]
    assert lake.dates(path) == ["2024-01-01", "2024-01-02"]
    assert rows(lake.read_latest(path)) == [(2, dt.date(2024, 1, 2))]
    with pytest.raises(FileNotFoundError):
        lake.read_date(path, "2024-01-03")


def test_each_row_goes_to_its_date_and_none_is_lost(spark, lake, rows):
    path = lake.bronze("s", "days")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "v int, d string")
    lake.write_dates(df, path, F.col("d").cast("date"))
    assert lake.dates(path) == ["2024-01-01", "2024-01-02"]
    assert rows(lake.read_latest(path), "v") == [(2,)]
    assert spark.read.parquet(path).count() == 3


def test_scratch_folder(spark):
    from types import SimpleNamespace

    from conform.session import scratch_dir

    named = scratch_dir(spark, "x")
    assert named.startswith(spark.conf.get("spark.checkpoint.dir")) and named != scratch_dir(spark, "x")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    assert "conform-" in scratch_dir(unset, "x")


def test_reading_a_date_prunes_the_others(spark, lake):
    path = lake.bronze("s", "t")
    for day in ("2024-01-01", "2024-01-02"):
        lake.write_date(spark.range(3), path, day)
    plan = lake.read_date(path, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "2024-01-02" in plan


def test_read_or_empty(spark, tmp_path):
    schema = snapshot_schema(spark.range(1).schema)
    none_yet = readers.read_or_empty(spark, str(tmp_path / "none"), schema)
    assert none_yet.count() == 0 and none_yet.columns == ["id", "valid_from", "valid_to"]
    spark.range(2).write.parquet(str(tmp_path / "some"))
    assert readers.read_or_empty(spark, str(tmp_path / "some"), spark.range(1).schema).count() == 2


def feed(spark, data):
    return spark.createDataFrame(data, "k string, a string, load_ts string")


def test_snapshot_versions_and_replay(spark, lake, rows):
    args = (["k"], ["a"])
    lake.update_snapshot("s", feed(spark, [("1", "a", "t1"), ("2", "b", "t1")]), *args, "2024-01-01")
    lake.update_snapshot("s", feed(spark, [("1", "A", "t2"), ("2", "b", "t2")]), *args, "2024-01-02")
    after_two = rows(lake.read_snapshot("s"))
    assert len(after_two) == 3 and ("2", "b", "t1", dt.datetime(2024, 1, 1), None) in after_two
    lake.update_snapshot("s", feed(spark, [("1", "A", "t3"), ("2", "b", "t3")]), *args, "2024-01-03")
    assert rows(lake.read_snapshot("s")) == after_two
    assert len(rows(lake.read_snapshot("s", 1))) == 2
    assert lake.read_snapshot("unknown") is None


def test_a_crashed_snapshot_run_leaves_no_trace(spark, lake, rows):
    args = (["k"], ["a"])
    lake.update_snapshot("s", feed(spark, [("1", "a", "t1")]), *args, "2024-01-01")
    before = rows(lake.read_snapshot("s"))
    half = lake.read_snapshot("s").withColumn("is_open", F.lit(1)).withColumn("a", F.lit("half"))
    half.write.partitionBy("is_open").parquet(lake.snapshot("s") + "/data/version=2")
    assert rows(lake.read_snapshot("s")) == before
    lake.update_snapshot("s", feed(spark, [("1", "b", "t2")]), *args, "2024-01-02")
    assert [r[1] for r in rows(lake.read_snapshot("s"))] == ["a", "b"]


def test_a_snapshot_update_does_not_read_closed_rows(spark, lake):
    args = (["k"], ["a"])
    for i, value in enumerate("abc"):
        lake.update_snapshot("s", feed(spark, [("1", value, "t")]), *args, f"2024-01-0{i + 1}")
    stored = spark.read.parquet(lake.snapshot("s") + "/data")
    opened = stored.where("is_open = 1 and version = 3")
    assert len(opened.inputFiles()) >= 1 and opened.count() == 1
    assert stored.where("is_open = 0").count() == 2


def test_publish_and_roll_back(spark, lake, rows):
    for run_id, n in (("r1", 1), ("r2", 2)):
        for model in ("m1", "m2"):
            lake.write_model(spark.range(n), lake.gold(run_id, model))
    assert lake.current_run() is None
    assert lake.publish("r1", ["m1", "m2"]) == {"m1": 1, "m2": 1}
    lake.publish("r2", ["m1", "m2"])
    assert lake.read_current("m1").count() == 2
    lake.publish("r1", ["m1", "m2"])
    assert lake.current_run() == "r1" and lake.read_current("m2").count() == 1
    assert lake.gold("r2", "m1") and lake.exists(lake.gold("r2", "m1"))


def test_missing_or_empty_models_are_not_published(spark, lake):
    lake.write_model(spark.range(1), lake.gold("good", "m1"))
    lake.publish("good", ["m1"])
    lake.write_model(spark.range(1), lake.gold("bad", "m1"))
    with pytest.raises(PublishError, match="m2 is missing"):
        lake.publish("bad", ["m1", "m2"])
    lake.write_model(spark.range(0), lake.gold("bad", "m2"))
    with pytest.raises(PublishError, match="m2 of run bad is empty"):
        lake.publish("bad", ["m1", "m2"])
    assert lake.current_run() == "good"


def test_names_follow_a_publish(spark, lake):
    for run_id, n in (("r1", 1), ("r2", 2)):
        lake.write_model(spark.range(n), lake.gold(run_id, "m"))
    for run_id, n in (("r1", 1), ("r2", 2)):
        lake.publish(run_id, ["m"])
        assert lake.register_current("v_") == ["v_m"] and spark.table("v_m").count() == n
        assert lake.register_current("t_", tables=True) == ["t_m"] and spark.table("t_m").count() == n
    spark.sql("DROP TABLE t_m")
    assert lake.read_current("m").count() == 2


def test_clustered_write_skips_files(spark, lake, rows):
    df = spark.range(10_000).withColumn("k", F.col("id") % 100).withColumn("year", F.lit(2020))
    stored = lake.write_clustered(df, lake.gold("r", "c"), ["k"], files=4)
    assert stored.count() == 10_000
    spans = stored.groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    assert len(spans) == 4 and max(r["hi"] - r["lo"] for r in spans) < 40
    folders = lake.write_clustered(df, lake.gold("r", "y"), ["k"], partitions=["year"], files=2)
    assert folders.count() == 10_000 and lake._children(lake.gold("r", "y")) == ["year=2020"]


def test_a_hot_cluster_value_is_shared_by_tasks(spark, lake):
    df = spark.range(8_000).withColumn("k", F.lit(1))
    stored = lake.write_clustered(df, lake.gold("r", "hot"), ["k"], files=8)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2_000


def test_quality_results_are_kept_once(spark, lake):
    from conform.operators import quality as q

    results = q.run_checks(spark.range(3), [q.not_null("id"), q.row_count(low=1)])
    for _ in range(2):
        lake.append_quality(results, "r1", "m")
    assert lake.read_quality("r1").count() == 2


def test_emptying_a_date_empties_it(spark, tmp_path):
    lake, path = Lake(spark, str(tmp_path)), str(tmp_path / "t")
    lake.write_date(spark.range(2), path, "2024-01-01")
    lake.write_date(spark.range(3), path, "2024-01-02")
    lake.write_date(spark.range(0), path, "2024-01-01")
    assert lake.read_date(path, "2024-01-01").count() == 0 and lake.read_date(path, "2024-01-02").count() == 3


def test_a_full_write_leaves_no_stale_folder(spark, tmp_path):
    lake, path = Lake(spark, str(tmp_path)), str(tmp_path / "t")
    both = spark.createDataFrame([(2007, 1), (2008, 2)], "year int, x int")
    lake.write_clustered(both, path, ["x"], partitions=["year"])
    lake.write_clustered(both.where("year = 2008"), path, ["x"], partitions=["year"])
    assert [r["year"] for r in spark.read.parquet(path).collect()] == [2008]


def test_a_published_run_cannot_be_changed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_model(spark.range(2), lake.gold("r1", "m"))
    lake.write_model(spark.range(3), lake.gold("r1", "m"))
    lake.publish("r1", ["m"])
    for write in (lake.write_model, lambda df, path: lake.write_clustered(df, path, ["id"])):
        with pytest.raises(PublishError, match="published"):
            write(spark.range(1), lake.gold("r1", "m"))
    assert lake.read_current("m").count() == 3


def test_a_wrapped_json_array_reads_like_a_bare_one(spark, tmp_path):
    for name, text in (("a", '[{"x": 1}, {"x": null}]'), ("b", '{"results": [{"x": 2}, {"x": 3}]}'), ("c", '{"results": []}')):
        (tmp_path / f"{name}.json").write_text(text)
    read = lambda n: [r["x"] for r in readers.read_json_array(spark, str(tmp_path / f"{n}.json"), "x int").collect()]
    assert (read("a"), read("b"), read("c")) == ([1, None], [2, 3], [])
