"""Hard negatives against scoring every pair."""

from __future__ import annotations

import numpy as np
import pytest

from conform.llm import hard_negatives as hn

RNG = np.random.default_rng(5)
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors, low=30, high=90, k=5, m=10):
    fine = [(i, la, [int(np.floor(256 * x)) for x in v]) for i, la, v in rows
            if i is not None and la is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, la, v in fine:
        if a not in anchors:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w, strict=True)), i, lb == la) for i, lb, w in fine if i != a and len(w) == len(v)), key=lambda t: t[:2])
        for p, i, _ in [t for t in scored if t[2]][:k]:
            fits = [t for t in scored if not t[2] and low * -p <= 100 * -t[0] <= high * -p][:m]
            out += [(a, i, n + 1, j, -p, -q) for n, (q, j, _) in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    schema = "vec_id long, label int, embedding array<float>, id string, rank int, score long, dim int, cell int, at int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], schema).repartition(3, "vec_id")


def mined(spark, rows, anchors, **options):
    df = frame(spark, rows)
    got = hn.mine_hard_negatives(df, df.where(df.vec_id.isin(list(anchors))), **options)
    return sorted(tuple(r[c] for c in COLS) for r in got.collect())


def vector(center, spread=0.3, dim=8):
    return [float(np.float32(x)) for x in center + spread * RNG.normal(size=dim)]


CENTERS = RNG.normal(size=(6, 8))


def test_equals_brute_force(spark):
    rows = [(i, int(RNG.integers(3)), vector(CENTERS[i % 6])) for i in range(400)]
    rows += [(400 + i, i % 3, [float(x) for x in RNG.integers(-1, 2, 8)]) for i in range(60)]  # ties
    rows += [(460, 1, [0.0] * 8), (461, 2, [0.0] * 8)]
    anchors = set(range(0, 462, 20)) | {460}
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_small_chunks_and_one_cell(spark):
    rows = [(i, i % 2, vector(CENTERS[0])) for i in range(150)]
    anchors = set(range(0, 150, 5))
    want = brute(rows, anchors)
    assert mined(spark, rows, anchors, cells=1, chunk=7) == want
    assert mined(spark, rows, anchors, cells=4, chunk=1, thin=1) == want


def test_nulls_repeats_lengths_and_hot_vectors(spark):
    rows = [(i, i % 3, vector(CENTERS[i % 2])) for i in range(60)]
    rows += [(100, None, rows[0][2]), (101, 1, None), (102, 1, []), (103, 1, [None] * 8), (104, 1, [float("nan")] * 8), (None, 1, rows[1][2]),
             (105, 1, [float("inf")] * 8), (106, 1, [1.0, 2.0]), (107, 1, [1.0, 1.0]), (108, 2, [0.5, 0.5])]
    rows += [(10, 1, rows[3][2]), (11, 1, rows[11][2]), (11, 1, rows[11][2])]
    rows += [(200 + i, i % 2, rows[5][2]) for i in range(90)]  # one vector on half of the rows
    anchors = {0, 5, 10, 11, 100, 101, 104, 106, 200, 201}
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_large_components(spark):
    rows = [(1, 1, [1e6, 1.0]), (2, 1, [1e6, -1e6]), (3, 2, [5e5, 0.0]), (4, 2, [1.0, 1.0])]  # products beyond 53 bits
    assert mined(spark, rows, {1, 2}) == brute(rows, {1, 2})
    huge = [(1, 1, [1e38]), (2, 1, [1e38]), (3, 2, [1e37])]
    assert {r[0] for r in mined(spark, huge, {1}, low=0, high=100)} == {1}


def test_no_rows(spark):
    rows = [(i, 1, vector(CENTERS[0])) for i in range(5)]
    assert mined(spark, rows, set()) == []
    assert mined(spark, rows, {1}) == []  # no other label
    df = frame(spark, rows).limit(0)
    assert hn.mine_hard_negatives(df, df).collect() == []


def test_a_walk_ends_early_and_bounds_hold():
    centers = RNG.normal(size=(40, 16))
    rows = np.floor(256 * (centers[np.arange(8000) % 40] + 0.05 * RNG.normal(size=(8000, 16))))
    members = rows[:400:40]  # of one center
    low, high = np.full((len(members), 1), hn.LOW), np.full((len(members), 1), hn.HIGH)
    cluster = hn.Cluster(members, np.arange(0, 400, 40), np.zeros(len(members), dtype=np.int64), low, high, 10, True, 0)
    units, norms = hn.directions(rows)
    bounds = cluster.bounds(units, norms)
    assert (members @ rows.T <= bounds[None, :] * cluster.norms[:, None] + 1e-3).all()
    walk = hn.Walk(cluster)
    walk.along(rows, units, norms, np.arange(8000), np.zeros(8000, dtype=np.int64))
    assert walk.scored < 0.1 * len(members) * len(rows)
    for r, i in enumerate(cluster.ids):
        scores = hn.products(members[r : r + 1], rows)[0]
        want = sorted((-s, j) for j, s in enumerate(scores) if j != i)[:10]
        assert [j for _, j in want] == walk.ids[walk.requests == r].tolist()


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_products_are_exact(scale):
    a, b = np.floor(scale * RNG.normal(size=(4, 5)) * 100), np.floor(scale * RNG.normal(size=(6, 5)) * 100)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert hn.products(a, b).tolist() == [[min(max(x, hn.LOW), hn.HIGH) for x in row] for row in want]
