"""Near-duplicate classes against brute force, and connected components."""

from __future__ import annotations

import random
import re

import pytest

from conform.llm import near_dup
from conform.llm.near_dup import components, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_sets(rows):
    out = {}
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.setdefault(i, set()).update({tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set())
    return out


def classes(edges, ids):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def brute(rows):
    sets = shingle_sets(rows)
    ids = sorted(sets)
    edges = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    found = classes(edges, ids)
    return {i: (len(sets[i]), found[i]) for i in ids}


def corpus(seed, size=160):
    """Chains of small edits around the threshold, a large near group, shared passages, copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(300))
    shared = [word() for _ in range(40)]
    texts = []
    for _ in range(size // 8):
        base = [word() for _ in range(rng.randrange(6, 120))]
        for _ in range(4):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = word()
        texts.append(" ".join([*shared, *[word() for _ in range(rng.randrange(1, 30))]]))
    core = [word() for _ in range(60)]
    for _ in range(40):
        near = list(core)
        near[rng.randrange(60)] = word()
        texts.append("\t".join(near).upper() if rng.random() < 0.2 else "\n".join(near))
    texts += ["", "  ", "one", "ONE", "one two", "a b c d e", "a b c d e", "é É x y z", "x" * 50_000, " ".join(core * 300)]
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "z", 0) for i, t in rows], "doc_id long, text string, id string, n long").repartition(6)
    got = near_duplicates(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_nulls_repeats_and_no_rows(spark):
    rows = [(3, None), (4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f"), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    assert got == sorted([(3, 0, 3), (4, 2, 4), (4, 2, 4), (None, 2, None), (9, 2, 4), (7, 0, 7)], key=repr)
    assert near_duplicates(df.limit(0)).collect() == []


def words(stem, n=40):
    return " ".join(f"{stem}{j}" for j in range(n))


@pytest.mark.parametrize("more", [[], [(8, words("a", 39) + " z"), (8, words("c")), (9, words("c", 39)), (9, None), (7, words("a") + " " + words("b"))]])
def test_an_id_of_several_texts_has_the_union_of_their_sets(spark, more):
    rows = [(1, words("a")), (5, words("a")), (2, words("b")), (5, words("b")), (5, None), *more]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, near_duplicates(df).collect()))
    want = brute(rows)
    assert got == sorted((i, *want[i]) for i, _ in rows)
    assert want[5][0] == 72 and want[1] == (36, 1)


def test_an_id_on_a_third_of_the_rows(spark):
    rows = [(i if i % 3 else 0, words("a") if i % 2 else words(f"t{i}")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert sorted(map(tuple, near_duplicates(df).collect())) == sorted((i, *want[i]) for i, _ in rows)


@pytest.mark.parametrize("long_list", [2, 7])
def test_split_lists_lose_no_link(spark, monkeypatch, long_list):
    monkeypatch.setattr(near_dup, "LONG_LIST", long_list)
    rng = random.Random(long_list)
    rows = []
    for pair in range(40):  # few representatives, many copies: the lists are split, and most salts hold one document or none
        base = [f"p{pair}w{j}" for j in range(60)]
        near = [*base[:-1], f"p{pair}other"]
        for _ in range(4):
            rows += [(rng.randrange(10**9), " ".join(base)), (rng.randrange(10**9), " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == brute(rows)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == classes([e for e in edges if e[0] != e[1]], ids)
