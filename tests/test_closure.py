"""Hierarchies of any depth against a walk in Python."""

from __future__ import annotations

import random

import pytest

from conform.operators import closure


def brute(edges):
    up = {k: (p if p in dict(edges) else None) for k, p in edges}
    out = {}
    for k in up:
        seen, at, depth = set(), k, 0
        while up[at] is not None and at not in seen:
            seen.add(at)
            at, depth = up[at], depth + 1
        out[k] = (at, depth) if up[at] is None else (None, None)
    return out


def found(spark, edges):
    rows = closure.hierarchy(spark.createDataFrame(edges, "id long, boss long"), "id", "boss").collect()
    assert len(rows) == len(edges)
    return {r["id"]: (r["root"], r["depth"]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_with_cycles(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.choice([None, rng.randrange(120), rng.randrange(max(1, i)), 999])) for i in range(100)]
    assert found(spark, edges) == brute(edges)


def test_a_long_chain_takes_few_rounds(spark):
    edges = [(i, i - 1 if i else None) for i in range(3000)]
    assert found(spark, edges) == {i: (0, i) for i in range(3000)}


def test_a_star_a_cycle_and_a_loop(spark):
    edges = [(0, None), *[(i, 0) for i in range(1, 500)], (600, 601), (601, 600), (602, 601), (603, 603)]
    got = found(spark, edges)
    assert got[499] == (0, 1) and all(got[i] == (None, None) for i in (600, 601, 602, 603))


def test_no_rows_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "id long, boss long")
    assert sorted(tuple(r) for r in closure.hierarchy(df, "id", "boss").collect()) == [(1, 1, 0), (2, 1, 1)]
    assert closure.hierarchy(df.limit(0), "id", "boss").collect() == []
    with pytest.raises(Exception, match="repeated key"):
        closure.hierarchy(df.union(df), "id", "boss")
