"""Secret spans, ownership and redaction against Python's regular expressions."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conform.llm import secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEY, LIVE = "AKIA" + "B2C4D6F8H1J3K5M7", "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
ROWS = [
    (1, f"token = \"{LIVE}\" and password: token: abcdefgh", "o1"),
    (2, f"é {KEY} {KEY} AKIASHORT", "o1"),
    (3, f"api_key={KEY}", "o2"),
    (4, None, "o1"), (5, "", None), (6, "SECRET='abc' secret=abcdef", "o3"), (7, "passwd=" + "ab" * 30, "o3"),
    (8, f"\U0001F600 x {LIVE}", "o1"), (9, "token=a" * 400 + f" {LIVE} " + "y " * 50_000, "o1"), (1, "token=again99", "o1"),
    (10, "apiKey:" + "0123456789abcdef01234567", "o4"), (11, "apikey : 0123456789abcdef01234567", "o5"),
]


def base(text):
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, "c", 1) for r in ROWS], "doc_id long, text string, source string, values string, live int").repartition(3, "doc_id")


def test_base_spans(docs):
    got = secrets.scan_secrets(docs).collect()
    found = sorted((r["doc_id"], sorted((x["start"], x["kind"], x["end"]) for x in r["base"])) for r in got)
    assert found == sorted((i, base(t or "")) for i, t, _ in ROWS)


def test_owned_values_look_live_and_shared_ones_do_not(docs):
    got = {r["doc_id"]: [(x["start"], x["end"]) for x in r["live"]] for r in secrets.scan_secrets(docs).where("doc_id > 1").collect()}
    at = ROWS[8][1].index(LIVE)
    assert got[8] == [(4, 4 + len(LIVE))] and got[9] == [(6, at - 1), (at, at + len(LIVE))]
    assert got[2] == [] and got[3] == []  # one value, two owners
    assert got[10] == [] and got[11] == []  # the same
    assert got[7] == [(7, 67)] and got[6] == [(20, 26)]  # of letters alone, and short
    strict = {r["doc_id"]: r["live"] for r in secrets.scan_secrets(docs, max_repos=4, any_form=False).where("doc_id > 1").collect()}
    assert strict[7] == [] and strict[6] == [] and len(strict[8]) == 1


def test_copies_of_one_owner_stay_live(spark):
    rows = [(i, f"token={LIVE}", "o1") for i in range(9)] + [(9, "secret: sharedvalue", "o1"), (10, "secret: sharedvalue", "o2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: len(r["live"]) for r in secrets.scan_secrets(df).collect()}
    assert got == {**{i: 1 for i in range(9)}, 9: 0, 10: 0}


def test_a_text_with_very_many_matches_is_not_quadratic(spark):
    import time

    text = " ".join(f"{i:032x}" for i in range(300_000))
    df = spark.createDataFrame([(1, text, "o1")], "doc_id long, text string, source string")
    start = time.time()
    got = secrets.scan_secrets(df).select(F.size("hex").alias("n"), F.element_at("hex", -1).alias("last"), F.element_at("hex", 200_001).alias("mid")).first()
    assert time.time() - start < 90
    assert got["n"] == 300_000 and (got["last"]["start"], got["last"]["end"]) == (299_999 * 33, len(text)) and got["mid"]["start"] == 200_000 * 33


def test_redact_keeps_rows_and_columns(docs):
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(ROWS) and texts[4] is None and texts[5] == ""
    assert texts[8] == "\U0001F600 x [secret]" and texts[3] == ROWS[2][1]
    assert texts[9] == "token=[secret] [secret] " + "y " * 50_000


def test_pipeline_masks_what_one_source_has_in_any_number_of_documents(spark):
    import corpus_pipeline as cp

    own = {"key": LIVE, "short": "hunter2", "letters": "correcthorsebattery", "access": KEY}
    text = "token={key} password: {short} secret = {letters} {access} password=example1".format(**own)
    rows = [(i, f"{text} {i}", "en", "o1") for i in range(7)] + [(7, "password=example1", "en", "o2"), (8, None, "en", "o1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as long) as n_chars")
    got = {r["doc_id"]: r for r in cp.mask_secrets(spark, df, "").collect()}
    masked = "token=[secret] password: [secret] secret = [secret] [secret] password=example1"
    assert {i: r["text"] for i, r in got.items()} == {**{i: f"{masked} {i}" for i in range(7)}, 7: "password=example1", 8: None}
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] else None) for r in got.values())


def test_no_rows(docs):
    assert secrets.scan_secrets(docs.limit(0)).collect() == []
    assert secrets.redact(docs.limit(0)).collect() == []


def test_plan_has_no_python(docs):
    plan = secrets.scan_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_redact_plans_are_short_whatever_the_hits(docs):
    assert len(secrets.redact(docs)._jdf.queryExecution().toString()) < 100_000  # the bitmap stood in it as a literal of 512 KB
    odd = docs.selectExpr("*", "1 as word", "2 as word_", "3 as bits", "4 as place", "5 as maybe")
    assert secrets.redact(odd).columns == odd.columns
    texts = {r["doc_id"]: (r["text"], r["word"], r["word_"], r["bits"], r["place"], r["maybe"]) for r in secrets.redact(odd).collect()}
    assert texts[8] == ("\U0001F600 x [secret]", 1, 2, 3, 4, 5) and texts[5] == ("", 1, 2, 3, 4, 5)
