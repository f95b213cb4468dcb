"""Quotation linking and reply order."""

from __future__ import annotations

import pytest

from conform.llm import quotes


def test_passages_of_nested_levels():
    text = "> > old\n> mid\n>also mid\nown\n\nown too\n >>> deep"
    assert quotes.passages(text) == [(2, "old"), (1, "mid\nalso mid"), (0, "own\n\nown too"), (3, "deep")]
    assert quotes.normalised("  A\n b\t C ") == "a b c"


@pytest.fixture
def mail(spark):
    rows = [
        ("t", 1, "Hello there\nsecond line"),
        ("t", 2, "> Hello  THERE\n> second line\nReply one"),
        ("t", 3, ">> hello there\n>> second line\n> reply one\nReply two\n> reply one\nmore"),
        ("t", 4, "> second line\nabout a part"),
        ("t", 5, "> never said\nlost"),
        ("u", 2, "> Hello there\n> second line\nother thread"),
        ("t", 6, None), ("t", 7, ">\n> \nblank quotes"), ("t", None, "> reply one\nno id"), ("t", 8, "Hello there\nsecond line"),
        (None, 1, "null scope"), (None, 2, "> null scope\nanswer"),
    ]
    return spark.createDataFrame([(*r, 0) for r in rows], "thread string, msg long, text string, row int").repartition(4)


def test_links(mail):
    got = {(r["thread"], r["msg"]): r for r in quotes.link_quotes(mail, "msg", scope=("thread",)).collect()}
    assert len(got) == 12
    expect = {
        ("t", 1): ("Hello there\nsecond line", 0, 0, None), ("t", 2): ("Reply one", 1, 1, 1),
        ("t", 3): ("Reply two\nmore", 3, 3, 2), ("t", 4): ("about a part", 1, 1, 1), ("t", 5): ("lost", 1, 0, None),
        ("u", 2): ("other thread", 1, 0, None), ("t", 6): ("", 0, 0, None), ("t", 7): ("blank quotes", 0, 0, None),
        ("t", None): ("no id", 0, 0, None), ("t", 8): ("Hello there\nsecond line", 0, 0, None),
        (None, 1): ("null scope", 0, 0, None), (None, 2): ("answer", 1, 1, 1),
    }
    assert {k: (r["clean"], r["n_quotes"], r["n_linked"], r["reply_to"]) for k, r in got.items()} == expect


def test_order_by_replies(mail):
    linked = quotes.link_quotes(mail, "msg", scope=("thread",))
    got = {(r["thread"], r["msg"]): (r["root"], r["depth"], r["position"]) for r in quotes.reply_order(linked, "msg", ("thread",)).where("msg is not null").collect()}
    assert got[("t", 3)] == (1, 2, 3) and got[("t", 2)] == (1, 1, 1) and got[("t", 4)] == (1, 1, 2) and got[("t", 1)] == (1, 0, 0)
    assert got[("t", 5)] == (5, 0, 0) and got[(None, 2)] == (1, 1, 1)


def test_long_chain(spark):
    rows = [(i, ("" if i == 0 else f"> line {i - 1}\n") + f"line {i}") for i in range(70)]
    df = spark.createDataFrame(rows, "msg long, text string")
    got = {r["msg"]: (r["root"], r["depth"]) for r in quotes.reply_order(quotes.link_quotes(df, "msg"), "msg").collect()}
    assert got == {i: (0, i) for i in range(70)}


def test_mail_view_comes_back_as_the_turns(spark):
    turns = spark.createDataFrame([(c, t, "user", f"said {c} {t}\nline" if t % 3 else f"said {c} {t}") for c in range(5) for t in range(6)], "conv_id long, turn long, role string, text string")
    linked = quotes.link_quotes(quotes.as_mail(turns), "turn", scope=("conv_id",))
    got = {(r["conv_id"], r["turn"]): (r["clean"], r["reply_to"]) for r in linked.collect()}
    assert got == {(r["conv_id"], r["turn"]): (r["text"], r["turn"] - 1 if r["turn"] else None) for r in turns.collect()}


def test_query_keeps_null_and_repeated_keys(spark, tmp_path):
    turns = [
        (1, 0, "user", "first"), (1, 1, "assistant", "second"), (1, 1, "user", "other second"), (1, 1, "user", "other second"), (1, 2, "user", "third"),
        (1, None, "system", "no turn"), (None, 0, "user", "no thread"), (None, 1, "assistant", "answer"), (None, None, None, "nothing"), (2, 0, "user", None),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = quotes.op9_chat(spark, str(tmp_path)).collect()
    assert sorted(((r["conv_id"], r["turn"], r["role"], r["text"]) for r in got), key=repr) == sorted({(*t[:3], t[3] or "") for t in turns}, key=repr)
    for r in got:
        assert r["reply_to"] == (r["turn"] - 1 if r["turn"] else None)
        assert (r["root"], r["depth"]) == (None if r["turn"] is None else 0, r["turn"])
    assert sorted(r["position"] for r in got if r["conv_id"] == 1 and r["turn"] is not None) == [0, 1, 2, 3]


@pytest.mark.parametrize("conversations", [1, 40])
def test_repeated_words_link_to_the_latest_before(spark, conversations):
    words = ["ok", "yes", "ok", "ok\nthen", "no"]  # turns of the same words, and lines of them
    turns = [(c, t, "user", words[(t * t + c) % 5]) for c in range(conversations) for t in range(2_000 // conversations)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    got = quotes.chat(df).collect()
    assert len(got) == len(turns)
    assert all((r["reply_to"], r["root"], r["depth"], r["position"]) == (r["turn"] - 1 if r["turn"] else None, 0, r["turn"], r["turn"]) for r in got)


def test_lines_link_to_the_latest_before(spark):
    rows = [(1, "one\ntwo"), (2, "two\nthree"), (3, "> two\nasked"), (4, "two\nfour"), (5, "> two\nagain"), (6, "> two\nown"), (None, "two\nfive")]
    got = quotes.link_quotes(spark.createDataFrame(rows, "msg long, text string"), "msg").collect()
    assert {r["msg"]: r["reply_to"] for r in got} == {1: None, 2: None, 3: 2, 4: None, 5: 4, 6: 4, None: None}


def test_no_rows(mail):
    none = quotes.link_quotes(mail.limit(0), "msg", scope=("thread",))
    assert quotes.reply_order(none, "msg", ("thread",)).collect() == []


def brute_links(rows):
    """Every quoted passage against every earlier message."""
    out = {}
    for thread, msg, at, text in rows:
        earlier = sorted((a, m, t) for h, m, a, t in rows if h == thread and a < at)
        own = [(a, m, [p for level, p in quotes.passages(t) if level == 0]) for a, m, t in earlier]

        def latest(key, lines, own=own):
            hits = [(a, m) for a, m, said in own
                    if key in ({quotes.normalised(x) for x in "\n".join(said).split("\n")} if lines else {quotes.normalised(x) for x in ("\n".join(said), *said)})]
            return max(hits, default=None)

        found, n = [], 0
        for level, p in quotes.passages(text):
            if level and quotes.normalised(p):
                n += 1
                o = latest(quotes.normalised(p), False)
                if o is None:
                    o = max((x for x in (latest(quotes.normalised(line), True) for line in p.split("\n") if quotes.normalised(line)) if x), default=None)
                found.append((level, o))
        linked = [(-level, *o) for level, o in found if o]
        out[thread, msg] = (n, len(linked), max(linked)[2] if linked else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_links_and_order_equal_a_quadratic_version(spark, seed):
    import random

    rng = random.Random(seed)
    rows = []
    for thread in "abc":
        n = 60 if thread == "a" else 15
        for i in range(n):
            said = [rng.choice(["one", "two", "three four", f"own {rng.randrange(8)}"]) for _ in range(rng.randint(1, 3))]
            lines = []
            for _ in range(rng.randint(0, 3)):
                source = [t for h, _, _, t in rows if h == thread] or ["nothing"]
                level = rng.randint(1, 3)
                lines += [">" * level + " " + x for x in rng.choice(rng.choice(source).split("\n")).split("\n")]
                lines += [rng.choice(said)] if rng.random() < 0.5 else []
            rows.append((thread, i, i if rng.random() < 0.8 else max(0, i - 1), "\n".join([*lines, *said])))
    df = spark.createDataFrame(rows, "thread string, msg long, at long, text string").repartition(4)
    linked = quotes.link_quotes(df, "msg", scope=("thread",), order_col="at")
    want = brute_links(rows)
    assert {(r["thread"], r["msg"]): (r["n_quotes"], r["n_linked"], r["reply_to"]) for r in linked.collect()} == want
    got = {(r["thread"], r["msg"]): (r["root"], r["depth"]) for r in quotes.reply_order(linked, "msg", ("thread",)).collect()}
    for (thread, msg), (*_, up) in want.items():
        root, depth = msg, 0
        while want[thread, root][2] is not None:
            root, depth = want[thread, root][2], depth + 1
        assert got[thread, msg] == (root, depth)


def test_cycles_end(spark):
    pointers = {1: 2, 2: 3, 3: 1, 4: 2, 5: 4, 6: None, 7: 6, 9: 9, 20: 21, 21: 20}
    rows = [("t", i, up, f"m{i}", "old", 0) for i, up in pointers.items()]
    df = spark.createDataFrame(rows, "thread string, msg long, reply_to long, clean string, root string, depth int")
    out = quotes.reply_order(df, "msg", ("thread",))
    got = {r["msg"]: (r["root"], r["depth"]) for r in out.collect()}
    assert got == {1: (1, 0), 3: (1, 1), 2: (1, 2), 4: (1, 3), 5: (1, 4), 6: (6, 0), 7: (6, 1), 9: (9, 0), 20: (20, 0), 21: (20, 1)}


def test_messages_that_quote_each_other(spark):
    rows = [(1, 0, "alpha"), (2, 3, "> alpha\nbeta"), (1, 5, "> beta\ngamma")]
    df = spark.createDataFrame(rows, "msg long, at long, text string")
    linked = quotes.link_quotes(df, "msg", order_col="at")
    assert {(r["msg"], r["root"]) for r in quotes.reply_order(linked, "msg").collect()} == {(1, 1), (2, 1)}
    with pytest.raises(ValueError, match="clean"):
        quotes.link_quotes(df, "msg", keep=("clean",))
