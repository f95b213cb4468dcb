"""Exact top-k search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conform.llm import top_k as search
from conform.llm.top_k import top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, asked, k):
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    ints = lambda v: [math.floor(256 * x) for x in v]
    out = []
    for q, v in sorted({i: ints(v) for i, v in asked if i is not None and fine(v)}.items()):
        scored = [
            (-sum(a * b for a, b in zip(v, ints(w), strict=True)), i)
            for i, w in rows if i is not None and i != q and fine(w) and len(w) == len(v)
        ]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("nodes", [1, 2, 5])
def test_equals_brute_force(spark, nodes):
    rng = np.random.default_rng(nodes)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(5, rows[9][1]), (None, rows[0][1]), (2000, None), (2001, []), (2002, [NAN] * 6), (2003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2004, [INF] * 6), (2010, [0.5, 0.25])]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(5)
    asked = [(i, v) for i, v in rows if i is not None and i % 10 == 0]
    got = top_k(df, df.where(F.col("vec_id") % 10 == 0), k=4, nodes=nodes, chunk=13)
    as_float = lambda v: v and [None if x is None else float(np.float32(x)) for x in v]
    want = brute([(i, as_float(v)) for i, v in rows], [(i, as_float(v)) for i, v in asked], 4)
    assert sorted(map(tuple, got.collect())) == want


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, top_k(df, df).collect())) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert top_k(df.limit(0), df.limit(0)).collect() == []
    assert top_k(df.where("vec_id = 0"), df.where("vec_id = 0")).collect() == []


@pytest.mark.parametrize("nodes", [1, 2, 5])
def test_cutoff_exists_and_thins_the_rows(spark, nodes):
    rng = np.random.default_rng(nodes)
    k, v = 4, np.float32(rng.normal(size=(1500, 10))).astype(np.float64)
    ids = np.arange(0, 1500, 100)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    whole = np.floor(256 * v).astype(np.int64)
    slices = search._slices(10, nodes)
    cutoff = search._cutoffs(df, ids, whole[ids], k, 256.0, slices)
    scores = whole[ids] @ whole.T
    scores[np.arange(len(ids)), ids] = search.LOW
    kth = np.sort(scores, axis=1)[:, -k]
    assert (cutoff[:, 0] > search.LOW).all() and (cutoff[:, 0] <= kth).all()
    sent = search._reaching([whole[ids][:, s] @ whole[:, s].T for s in slices], cutoff)
    assert sent.sum() < 0.7 * sent.size
    assert sent[scores >= cutoff].all()


def test_empty_places_rank_last():
    s = np.array([[search.LOW, 5, search.LOW, 9, -7, 1]])
    assert sorted(s[0, search._highest(s, 3)[0]]) == [1, 5, 9]


def test_large_components_do_not_overflow(spark):
    rows = [(0, [1e9, 1.0]), (50, [1e9, -1e9]), (7, [2e8, 0.0]), (8, [-1e9, 5.0]), (9, [1e300, 1e300]), (100, [1e300, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    high, low = (1 << 63) - 1, -(1 << 63)
    cut = lambda x: max(-(1 << 62), min(1 << 62, math.floor(256 * x)))
    clip = lambda x: max(low, min(high, x))

    def score(a, b):  # slice by slice, each a long
        total = 0
        for x, y in zip(a, b, strict=True):
            total = clip(total + clip(cut(x) * cut(y)))
        return total

    got = {(r["query_id"], r["vec_id"]): r["score"] for r in top_k(df, df, k=5).collect()}
    assert got == {(i, j): score(v, w) for i, v in rows for j, w in rows if i != j}


def test_many_chunks_give_a_plan_of_one_scan(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(120)], "vec_id long, embedding array<double>")
    got = top_k(df, df.where("vec_id < 30"), k=2, chunk=5)
    assert got.count() == 60
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
