"""The filter audit against running every order of the filters one after the other."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from conform.llm import audit

RNG = random.Random(7)
LONG = " ".join(f"w{i}" for i in range(60))
SHORT, REPEATED, SHOUT, MARKS = "one two", "ab cd " * 40, " ".join(f"W{i}X" for i in range(60)), LONG + " #"
TEXTS = [LONG, SHORT, REPEATED, SHOUT, MARKS, "", None, "É" * 30 + " Aé", "a\x1cb\x85c\x0bd", "X| " * 60, LONG.upper() + " $"]


def documents():
    rows = [(i, RNG.choice(TEXTS), RNG.choice(["s0", "s0", "s1", "", None])) for i in range(150)]
    rows += [(7, LONG, "s0"), (7, LONG, "s0"), (None, LONG, "s1"), (None, SHORT, None), (3, "other " * 3, "s1")]
    rows += [(1000, LONG + " " + " ".join(f"v{i}" for i in range(200_000)), "s1")]
    return rows


LABELS = [(i, RNG.choice([0, 1, None]), RNG.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]


def fails(letter, row, rows):
    i, text, _ = row
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if letter == "A":
        return len(words) < 50
    if letter == "B":
        return 100 * len(set(words)) < 65 * len(words)
    if letter == "C":
        return 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)
    if letter == "D":
        return re.search(r"[#$%&*|]", text) is not None
    return i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)


def brute(rows):
    good = {i for i, q, _ in LABELS if i is not None and q == 1}
    toxic = {i for i, _, x in LABELS if i is not None and x == 1}
    failed = [{c for c in "ABCDE" if fails(c, r, rows)} for r in rows]
    out, shares = {}, {}
    for order in itertools.permutations("ABCDE"):
        alive, here = list(range(len(rows))), {}
        for k, c in enumerate(order):
            gone = [r for r in alive if c in failed[r]]
            alive = [r for r in alive if c not in failed[r]]
            for part in {r[2] or "" for r in rows}:
                of = lambda xs, part=part: [x for x in xs if (rows[x][2] or "") == part]
                all_failing = of([r for r in range(len(rows)) if c in failed[r]])
                here = (len(of(alive)), len(of(gone)), len(all_failing) - len(of(gone)), len([r for r in all_failing if failed[r] == {c}]),
                        sum(rows[r][0] in good for r in of(gone)), sum(rows[r][0] in toxic for r in of(gone)))
                out[part, "".join(order), k + 1] = here
                shares[part, c] = shares.get((part, c), 0) + here[1]
    return {(p, o, k): (*v, shares[p, o[k - 1]]) for (p, o, k), v in out.items()}


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def frame(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id long, text string, source string, row int, digest string, is_good int, failed int")
    return docs.repartition(5, "doc_id")


def test_equals_running_every_order(spark, labels):
    rows = documents()
    got = audit.filter_audit(frame(spark, rows), labels).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in got}
    assert len(got) == len(found) == 3 * 120 * 5
    assert found == brute(rows)


def test_one_text_on_most_rows(spark, labels):
    """A hot text, a hot part and a hot null id."""
    rows = [(i if i % 3 else None, LONG, "s0") for i in range(900)]
    got = audit.filter_audit(frame(spark, rows), labels).where("filter_order = 'ABCDE' and step = 5").first()
    assert (got["kept"], got["removed"]) == (301, 599)


def test_words_hold_a_bit_per_survived_subset(spark):
    failed = audit.failures(frame(spark, documents()))
    rows = audit.survival_words(failed, 5).collect()
    assert all((r["word"] >> s & 1) == (r["failed"] & s == 0) for r in rows for s in range(32))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 100, 1000])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    want = ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(axis=0)
    assert np.array_equal(audit.positional_counts(words), want)


def test_other_filters_and_none_over_the_table(spark):
    tests = {"L": lambda raw, words: len(raw) > 10, "W": lambda raw, words: len(words) > 1}
    rows = [(1, "a b", "p"), (2, "a long text here", "p"), (3, "tiny", "p")]
    got = audit.audit(audit.survivors(audit.survival_words(audit.failures(frame(spark, rows), tests, None), 2), {}, 2), "LW", {})
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in got.collect()) == [
        ("LW", 1, 2, 1, 0, 1), ("LW", 2, 1, 1, 1, 3), ("WL", 1, 1, 2, 0, 3), ("WL", 2, 1, 0, 1, 1),
    ]
    with pytest.raises(ValueError):
        audit.failures(frame(spark, rows), {c: tests["L"] for c in "ABCDE"}, "F")


def test_no_rows(spark, labels):
    assert audit.filter_audit(frame(spark, []).limit(0), labels).collect() == []
    assert len(audit.filter_audit(frame(spark, documents()[:1]), labels.limit(0)).collect()) == 600
