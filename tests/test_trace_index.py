"""The indexed trace against the plain one, and the files it opens."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import reconcile, trace_index
from conform.operators.trace_index import IndexedLayer
from conform.sources.lake import Lake, file_count


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    lines = spark.range(4_000).select((F.col("id") / 4).cast("long").alias("order"), "id", F.md5(F.col("id").cast("string")).alias("text"))
    orders = spark.range(900).select(F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("status"))
    orders = orders.unionByName(spark.createDataFrame([(None, "null key")], "o long, status string"))
    lake.write_clustered(lines, lake.silver("lines"), ["order"], files=20)
    lake.write_clustered(orders, lake.silver("orders"), ["o"], files=10)
    out = [
        IndexedLayer("lines", lake.silver("lines"), F.sha2(F.col("text"), 256), "key", ["order", "id"]),
        IndexedLayer("orders", lake.silver("orders"), F.col("o"), "order", ["status"]),
    ]
    for layer in out:
        trace_index.write_index(spark, layer)
    return out


def plain(spark, layers):
    return [reconcile.Layer(x.name, spark.read.parquet(x.path), x.key, x.upper_key, x.keep) for x in layers]


def start(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "n long")
    return rows.withColumn("key", F.sha2(F.md5(F.col("n").cast("string")), 256))


@pytest.mark.parametrize("ids", [[5], [1, 2, 3, 3999, 100000], list(range(0, 4000, 7)), [], [None, 4]])
def test_equals_the_plain_trace(spark, rows, layers, ids):
    got = trace_index.trace_indexed(start(spark, ids), layers)
    assert rows(got) == rows(reconcile.trace_back(start(spark, ids), plain(spark, layers)))
    assert got.count() == len(ids)


def test_a_hop_opens_the_files_that_hold_its_keys(spark, layers):
    asked = start(spark, [5, 6]).select(F.xxhash64("key").alias("h"))
    assert len(trace_index.files_of(spark, layers[0], asked)) == 1  # of 20
    spread = start(spark, [0, 1_000, 2_000]).select(F.xxhash64("key").alias("h"))
    assert len(trace_index.files_of(spark, layers[0], spread)) == 3
    assert trace_index.files_of(spark, layers[0], start(spark, [9_999_999]).select(F.xxhash64("key").alias("h"))) == []


def test_keys_of_other_types_are_refused(spark, layers):
    with pytest.raises(ValueError, match="bigint"):
        trace_index.trace_indexed(start(spark, [1]), [IndexedLayer("orders", layers[1].path, F.col("o"), "key", ["status"])])


def test_no_task_of_the_build_grows_with_the_layer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trace_index, "TASK_ROWS", 400, raising=False)
    lake = Lake(spark, str(tmp_path))
    lines = spark.range(8_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(7)).alias("k"))
    stored = lake.write_clustered(lines, lake.silver("lines"), ["id"], files=file_count(lines, 2, rows=500))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1_000 and file_count(lines, 20, rows=500) == 20 and file_count(lines.limit(0)) == 1
    layer = IndexedLayer("lines", lake.silver("lines"), F.col("k"), "key", ["id"])
    trace_index.write_index(spark, layer)
    index = spark.read.parquet(layer.index)
    tasks = index.groupBy(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)).count().collect()
    assert max(r["count"] for r in tasks) < 1_000  # one of 8 shuffle partitions, coalesced, held more
    assert index.agg(F.sum("rows")).first()[0] == 8_000 and index.count() == 5_332 + 16
    start = spark.createDataFrame([(7,), (8,), (9,)], "key long")
    assert trace_index.trace_indexed(start, [layer]).count() == 2_667 + 1 + 1 + 1
