"""Greedy string tiling against a quadratic version, and decontamination end to end."""

from __future__ import annotations

import random

import numpy as np
import pytest

from conform.llm import tiling


def brute(item, doc, least):
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return out
        n, i, j = -best[0], best[1], best[2]
        a[i : i + n] = [True] * n
        b[j : j + n] = [True] * n
        out.append((i, j, n))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([2, 3, 6, 40])
    item = np.array([rng.randrange(alphabet) for _ in range(rng.randrange(0, 30))], dtype=np.uint32)
    doc = [rng.randrange(alphabet) for _ in range(rng.randrange(0, 40))]
    if len(item) > 8 and seed % 2:
        doc = doc[:5] + item[4:].tolist() + doc[5:9] + item[:4].tolist()
    doc = np.array(doc, dtype=np.uint32)
    assert tiling.tiles(item, doc, 3) == brute(item.tolist(), doc.tolist(), 3)


def test_running_hashes_tell_windows_apart():
    x = np.array([1, 2, 3, 1, 2, 3, 1, 2], dtype=np.uint32)
    h = tiling.running_hashes(x, 3)
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 3
    assert len(tiling.running_hashes(x, 9)) == 0


def test_contaminated_documents(spark):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    item = words(40)
    moved = item[25:] + words(30) + item[:25]
    rows = [
        (1, " ".join(words(50) + item + words(50))), (2, " ".join(moved).upper() + "!"), (3, " ".join(words(80))),
        (4, " ".join(item[:12] + words(100))), (5, None), (6, ""), (7, ", ".join(words(30_000) + item)), (None, " ".join(item)),
        (8, " ".join(w for pair in zip(item, words(40)) for w in pair)), (1, " ".join(item)),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item int, seed string").repartition(4)
    bench = spark.createDataFrame([(100, " ".join(item), 0), (101, "too short item", 0), (102, None, 0), (None, " ".join(item), 0), (103, "", 0)], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"], round(r["coverage"], 3), r["n_tiles"]) for r in tiling.contaminated(docs, bench).collect()}
    assert got == {(1, 100, 1.0, 1), (2, 100, 1.0, 2), (7, 100, 1.0, 1), (None, 100, 1.0, 1)}
    assert tiling.contaminated(docs.limit(0), bench).collect() == []
    assert tiling.contaminated(docs, bench.limit(0)).collect() == []


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "four unusual benchmark words"), (2, "the cat"), (3, "猫は静かに窓の外を見ていた"), (4, "supercalifragilistic")]
    rows = [
        (10, "here are four unusual benchmark words, hidden"), (11, "four unusual words of a benchmark"), (12, "the cat sat"),
        (13, "昨日、猫は静かに窓の外を見ていた。そして眠った。"), (14, "猫は窓の外"), (15, "so Supercalifragilistic!"), (None, "four unusual benchmark words"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in tiling.contaminated(docs, bench).collect()}
    assert got == {(10, 1), (13, 3), (15, 4), (None, 1)}


def test_rows_of_one_id_are_told_apart(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item), (1, "clean text"), (2, "clean text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = tiling.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["text_sha"]) for r in found] == [(1, __import__("hashlib").sha256(item.encode()).hexdigest())]
