"""Line-first cleaning against a plain Python reading of the rules."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import pytest

from conform.llm import line_rules as lr

RNG = random.Random(3)
PROSE = "The old harbour of the town was quiet in the early morning, and nobody spoke a word."
MENU, LINK, LICENCE, SHOUTED, DECORATED = "Home | News | Sport | About", "  Read More ", "Licensed under the Apache License, Version 2.0.", "BUY!! NOW!! FAST!!", "Of%%% athe*** erntwh.%%% the&&&"
LINES = [PROSE, MENU, LINK, LICENCE, SHOUTED, DECORATED, "", "   ", "A heading without a mark", "Он сказал: «да.»", "今日は晴れ。明日は雨", "x", "Really?! Yes.", "a\x0bb\x1cc d.", "We use COOKIES here."]
JAVA_TO_PY = lambda p: re.sub(r"\\x\{([0-9A-F]{4})\}", lambda m: chr(int(m[1], 16)), p).replace(r"\z", r"\Z")
SENTENCE, SEPARATOR = re.compile(JAVA_TO_PY(lr.SENTENCE)), re.compile(JAVA_TO_PY(lr.SEPARATOR))


def rule(line):
    n, low = len(re.findall(lr.WORD, line)), line.lower()
    if len(SEPARATOR.findall(line)) >= 2 and 5 * len(SEPARATOR.findall(line)) > n:
        return "navigation"
    if n <= 3 and low.strip(" \t\n\v\f\r") in lr.LINKS:
        return "navigation"
    if any(p in low for p in lr.BOILERPLATE):
        return "boilerplate"
    if not SENTENCE.search(line) or 5 * len(re.findall(lr.SHOUT, line)) > n or 4 * len(re.findall(lr.DECORATION, line)) > n:
        return "punctuation"
    return None


def brute(text):
    text = text or ""
    words = re.findall(lr.WORD, text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    covered = {i + j for i, run in enumerate(runs) if often[run] > 1 for j in range(5)}
    lines = text.split("\n")
    with_word = [x for x in lines if re.search(lr.WORD, x)]
    why = Counter(rule(x) for x in with_word)
    lost = sum(sum(map(len, re.findall(lr.WORD, x))) for x in with_word if rule(x))
    chars = sum(map(len, words))
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": len(re.findall(lr.SYMBOL, text)), "n_dup_lines": len(with_word) - len(set(with_word)),
        "n_repeat_words": len(covered), "n_punctuation": why["punctuation"], "n_navigation": why["navigation"], "n_boilerplate": why["boilerplate"],
        "lost_chars": lost, "base_failed": base, "kept": not base and 100 * lost <= 50 * chars,
        "clean_text": "\n".join(x for x in lines if not re.search(lr.WORD, x) or rule(x) is None),
    }


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n_words int, _words string").repartition(3)


def texts():
    out = [None, "", " \n\t", PROSE, "\n".join([PROSE] * 3), "a b c d e f a b c d e g", "a a a a a a", "a b c d e", "a " * 5 + "b " * 200 + "a " * 5, MENU + "\n" + PROSE, "é" * 30]
    out += ["\n".join(RNG.choices(LINES, k=RNG.randint(1, 12))) for _ in range(60)]
    out += [" ".join(RNG.choices("ab cd ef gh i".split(), k=RNG.randint(4, 400))) + "." for _ in range(30)]
    return out


def test_equals_python(spark):
    rows = list(enumerate(texts())) + [(None, PROSE), (3, PROSE), (3, PROSE)]
    got = lr.clean_lines(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    key = lambda x: sorted(map(repr, x))
    assert key((r["doc_id"], *[r[c] for c in brute("")]) for r in got) == key((i, *brute(t).values()) for i, t in rows)


def test_a_long_text_is_not_quadratic(spark):
    words = [f"w{i % 70_001}" for i in range(300_000)]
    start = time.time()
    got = lr.clean_lines(frame(spark, [(1, " ".join(words) + ".")])).first()
    assert got["n_words"] == 300_000 and got["n_repeat_words"] == brute(" ".join(words) + ".")["n_repeat_words"]
    assert time.time() - start < 60


def test_clean_documents_stay_and_junk_goes(spark):
    from conform.llm.common import read

    labels = read(spark, "/root/testdata/sf0.1", "labels")
    judged = lr.clean_lines(read(spark, "/root/testdata/sf0.1", "documents")).join(labels, "doc_id").where("n_words >= 10")
    good, kept, bad, gone = judged.selectExpr(
        "count_if(quality = 1)", "count_if(quality = 1 and kept)", "count_if(quality = 0)", "count_if(quality = 0 and not kept)"
    ).first()
    assert kept >= 0.98 * good and gone >= 0.9 * bad


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = lr.clean_lines(frame(spark, [(1, PROSE)]).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "Exchange" not in lr.clean_lines(docs)._jdf.queryExecution().executedPlan().toString()


def test_no_rows(spark):
    assert lr.clean_lines(frame(spark, []).limit(0)).collect() == []
