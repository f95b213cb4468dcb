from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conform.operators import joins, match
from conform.operators.match import Seed

NSAID = "Nonsteroidal Anti-inflammatory Drug"
SEED = [
    ("M01AB", NSAID, "diclofenac"), ("M01AE", NSAID, "ibuprofen"), ("N02BA", "Salicylate", "aspirin"),
    ("R06", "Antihistamine", "loratadine"), ("X01", "Zzz", "zinc"),
]
CASES = [
    ("A01", "Ibuprofen", NSAID + " [EPC]", "M01AE", False, "exact"),
    ("A02", "Naproxen", NSAID + " [EPC]", "M01AB", False, "normalized"),
    ("A03", "Loratadine 10 mg", None, "R06", False, "fuzzy"),
    ("A04", "Loratadine and Pseudoephedrine", None, "R06", True, "combination_unverified"),
    ("A05", "Loratadinex", None, None, False, "unmatched"),
    ("A06", None, None, None, None, "unmatched"),
    ("A07", None, "Antihistamine [EPC]", "R06", None, "normalized"),
    ("A08", "aspirin/caffeine", None, "N02BA", True, "combination_unverified"),
    ("A09", " ASPIRIN ", None, "N02BA", False, "exact"),
    ("A10", "Ibuprofen with Loratadine", None, "M01AE", True, "combination_unverified"),
    ("A11", "Ibuprofen and Famotidine", NSAID + " [EPC]", "M01AB", True, "normalized"),
    ("A12", "diclofenac ibuprofen", None, "M01AB", False, "fuzzy"),
    ("A13", "zinc oxide", None, None, False, "unmatched"),
    ("A14", "zinc", None, "X01", False, "exact"),
]


def seed_of(spark, rows):
    return Seed(spark.createDataFrame(rows, "code string, hint string, example string"), "code", "hint", "example")


def products_of(spark, rows):
    return spark.createDataFrame(rows, "k string, name string, klass string")


def run(spark, products, seed, strategy, **kw):
    out = match.tiered_match(
        products_of(spark, products), seed_of(spark, seed), ["k"], "name", "klass", strategy=strategy, **kw
    )
    cols = ["k", "code", "is_combination_product", "match_confidence"]
    return sorted(tuple(r) for r in out.select(cols).collect())


@pytest.mark.parametrize("strategy", ["auto", "inline", "index"])
def test_worked_examples(spark, strategy):
    got = run(spark, [c[:3] for c in CASES], SEED, strategy)
    assert got == [(k, code, combo, tier) for k, _, _, code, combo, tier in CASES]


def test_salted_answers_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(joins, "needs_salt", lambda left, right: True)
    many = [(f"{c[0]}.{i}", c[1], c[2]) for c in CASES for i in range(40 if c[0] == "A03" else 1)]
    got = run(spark, many, SEED, "index")
    want = {k: (code, combo, tier) for k, _, _, code, combo, tier in CASES}
    assert got == sorted((k, *want[k.split(".")[0]]) for k, _, _ in many)


@pytest.mark.parametrize("strategy", ["inline", "index"])
def test_input_order_does_not_matter(spark, strategy):
    rng = random.Random(1)
    products = rng.sample([c[:3] for c in CASES], len(CASES))
    got = run(spark, products, rng.sample(SEED, len(SEED)), strategy)
    assert got == [(k, code, combo, tier) for k, _, _, code, combo, tier in CASES]


def like(haystack: str, needle: str) -> bool:
    pattern = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in f"%{needle}%")
    return re.fullmatch(pattern, haystack, re.S) is not None


def brute_force(products, seed, min_len):
    out = []
    for k, name, klass in products:
        combo = None
        if name is not None:
            low = name.lower()
            combo = " and " in low or " with " in low or "/" in low
        hits = []
        for code, hint, example in seed:
            if code is None:
                continue
            if None not in (name, example) and name.lower().strip(" ") == example.lower().strip(" "):
                hits.append((1, code))
            elif None not in (klass, hint) and like(klass.lower(), hint.lower()):
                hits.append((2, code))
            elif None not in (name, example) and len(example) >= min_len:
                if re.search(rf"\b{example.lower()}\b", name.lower()):
                    hits.append((4 if combo else 3, code))
        tier, code = min(hits, default=(0, None))
        names = ["unmatched", *match.TIERS]
        out.append((k, code, combo, names[tier]))
    return sorted(out)


WORDS = ["zinc", "oxide", "red", "iron", "co", "b12", "and", "with", "a/b", "x", "Δός", "naïve", "5%", "b_1"]
SEPARATORS = [" ", "-", ", ", "  ", "/", ""]
HINTS = ["zin", "ed", "x", "", "%", "_", "i%n", "o_i", "d i", "Δ", "5%", "b_1", "\\", "nothing here"]


def random_text(rng, n):
    parts = []
    for _ in range(rng.randint(1, n)):
        parts += [rng.choice(WORDS), rng.choice(SEPARATORS)]
    return "".join(parts[:-1])


@pytest.mark.parametrize("strategy", ["inline", "index"])
@pytest.mark.parametrize("seed_no", [0, 1])
def test_random_texts_against_brute_force(spark, strategy, seed_no):
    rng = random.Random(seed_no)
    products = [
        (f"p{i}", rng.choice([None, random_text(rng, 4), random_text(rng, 2)]), rng.choice([None, random_text(rng, 3)]))
        for i in range(250)
    ]
    seed = [
        (f"c{i:02d}", rng.choice([None, *HINTS[5 * seed_no:]]), rng.choice([None, random_text(rng, 2), "zin.", "(red|iron) oxide"]))
        for i in range(40)
    ]
    assert run(spark, products, seed, strategy, min_len=3) == brute_force(products, seed, 3)


def test_a_large_seed_uses_the_index(spark):
    seed = [(f"c{i:05d}", f"hint{i}", f"substance{i}") for i in range(2 * match.INLINE_ROWS)]
    products = [("p1", "substance7 tablets", None), ("p2", None, "a hint3 class"), ("p3", "none", None)]
    want = [("p1", "c00007", False, "fuzzy"), ("p2", "c00003", None, "normalized"), ("p3", None, False, "unmatched")]
    assert run(spark, products, seed, "auto") == want
    assert run(spark, products, seed, "inline") == want


@pytest.mark.parametrize("strategy", ["inline", "index"])
def test_any_number_of_regexes_is_matched(spark, strategy):
    seed = [(f"c{i:05d}", None, f"substance.{i}") for i in range(300)]
    want = [("p1", "c00007", False, "fuzzy"), ("p2", "c00299", False, "fuzzy"), ("p3", None, False, "unmatched")]
    products = [("p1", "substance 7", None), ("p2", "substance-299", None), ("p3", "substance 300", None)]
    assert run(spark, products, seed, strategy) == want


def test_no_cross_join_in_either_plan(spark):
    for strategy in ("inline", "index"):
        out = match.tiered_match(
            products_of(spark, [c[:3] for c in CASES]), seed_of(spark, SEED), ["k"], "name", "klass", strategy=strategy
        )
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        if strategy == "inline":
            assert "Exchange" not in plan


def test_coverage_and_exceptions(spark, rows):
    matched = match.tiered_match(
        products_of(spark, [c[:3] for c in CASES]), seed_of(spark, SEED), ["k"], "name", "klass"
    )
    report = {r[0]: (r[1], r[2]) for r in match.coverage(matched).collect()}
    assert report["exact"] == (3, 3 / 14) and sum(n for n, _ in report.values()) == 14
    odd = matched.withColumn("match_confidence", F.when(F.col("k") > "A07", F.col("match_confidence")))
    assert sum(r["rows"] for r in match.coverage(odd).collect()) == 7
    quarantined = rows(match.match_exceptions(matched), "k", "exception_reason")
    assert ("A05", "match: unmatched") in quarantined
    assert ("A04", "match: combination_unverified") in quarantined and len(quarantined) == 6
    assert rows(match.top_unmatched(matched, "name", 2)) == [("Loratadinex", 1), ("zinc oxide", 1)]


def test_key_coverage_of_an_empty_table(spark, rows):
    empty = spark.createDataFrame([], "a int")
    assert rows(match.key_coverage(empty, ["a"])) == [("a", 0, 0, None)]


REGEXES = [
    "substance.7", "(red|iron) oxide", "zin.", "a(b(c|d)e)+f", "x*yz?abc", "foo|bar", "(foo|ba.*)qux", r"a\.b", r"\d+zz", "(?=x)abc", "(abc)?def",
    "a{2,3}bcd", "[]a]bc", "ab+c", "(ab)+c", "(ab)+?c", r"\x41bcd", "(a|b)(c|d)(e|f)xyz", "^start$", "naïve.δός", "colou?r", "(?:ab|cd)e",
    "(a(b|c)?d|ef)g", "(((a)))b", r"a\(b\)c", r"a\|b", r"[^\]]x", "(ab){2}c", "((a|b)c|d)+e", "a.c|b", "[a-c]x[^d]y", r"a\\b", "x{0}abc", "(a|b|)cd",
]


def test_every_match_of_a_regex_holds_the_runs_of_a_way(spark):
    from conform.functions.patterns import literal_runs

    rng = random.Random(1)
    parsed = spark.createDataFrame([(r,) for r in REGEXES], "r string").select("r", literal_runs(F.col("r")).alias("ways")).collect()
    assert sum(r["ways"] is not None for r in parsed) > 25
    alphabet = "abcdefgxyz(|)\\.0279 ]δ"
    for row in parsed:
        pattern = re.compile(row["r"].replace("[]a]", r"[\]a]"))
        seeds = [row["r"], "".join(c for c in row["r"] if c not in "()[]{}*+?^$|\\"), *["".join(run for run in way) for way in row["ways"] or []]]
        for _ in range(3000):
            t = list(rng.choice(seeds))
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(t))
                t[at : at + rng.randint(0, 1)] = rng.choices(alphabet, k=rng.randint(0, 2))
            t = "".join(t)
            if row["ways"] is not None and pattern.search(t):
                assert any(all(run in t for run in way) for way in row["ways"]), (row, t)


def test_a_regex_is_tried_on_names_that_hold_its_runs_only(spark):
    from conform.functions.patterns import literal_runs

    names = spark.range(2000).selectExpr("concat('substance ', id, ' tablet') as _n")
    index = spark.range(400).selectExpr("concat('substance.', 5 * id, ' tablet') as term", "cast(id as string) as code")
    trials = match.regex_trials(names, index.withColumn("ways", literal_runs(F.col("term"))))
    assert trials.count() <= 400 * 25  # of 800,000 pairs
    assert match._regex_hits(names, index).select("_n").distinct().count() == 400


def test_rows_per_text_follow_its_hits_not_its_length(spark):
    index = spark.createDataFrame([("zinc ox", "c1"), ("a%b", "c2"), ("%", "c3"), ("q", "c4")], "term string, code string")
    keyed = match._with_gram(index.where("term <> '%'"), "filter(split(term, '[%_]'), r -> r != '')")
    texts = spark.range(1000).selectExpr("concat('class number ', id, ' of some length') as _c")
    pieces = match.owned_pieces(texts, "_c", keyed)
    assert set(r["piece"] for r in keyed.collect()) & {"a", "b"} and pieces.where("piece not in ('a', 'b', 'q')").count() < 10
    assert pieces.groupBy("_c").count().agg(F.max("count")).first()[0] <= 3
    assert match.owned_pieces(texts, "_c", keyed.limit(0)).count() == 0


def test_an_inline_seed_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(match, "MOST_INLINE", 3)
    seed = [(f"c{i}", None, f"name{i}") for i in range(4)]
    with pytest.raises(ValueError, match="index"):
        run(spark, [("p", "name1", None)], seed, "inline")
    assert run(spark, [("p", "name1", None)], seed, "index") == run(spark, [("p", "name1", None)], seed, "auto")
