"""Classifiers: inference against enumeration, held-out accuracy, odd input."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from conform.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    chain = quality.Chain(rng.normal(size=quality.WIDTH), rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, quality.WIDTH)).astype(np.float32) * 0.2
    unary = x @ chain.weights
    mass, good = 0.0, np.zeros(6)
    for states in itertools.product((0, 1), repeat=6):
        s = sum(u for u, y in zip(unary, states) if y) + sum(chain.moves[a, b] for a, b in zip(states, states[1:]))
        mass += np.exp(s)
        good += np.exp(s) * np.array(states)
    assert np.allclose(chain.marginals(x), good / mass)


def test_line_features_of_odd_texts():
    for text in ("", "\n", "\n\n\n", "a", "É" * 5, "\U0001F600\n漢字", "x\n" * 3, "word " * 100_000):
        x, lengths = quality.line_features(text)
        assert x.shape == (text.count("\n") + 1, quality.WIDTH) and np.isfinite(x).all()
        assert lengths.sum() == len(text) - text.count("\n")


def test_neighbours_count():
    x, _ = quality.line_features("AAA BBB\nplain words here")
    own = quality.OWN
    assert (x[1, own : 2 * own] == x[0, :own]).all() and (x[0, 2 * own :] == x[1, :own]).all() and not x[0, own : 2 * own].any()


def test_one_class_and_no_labels():
    x = [quality.line_features("some good text")[0]]
    assert quality.fit_chain(x, [1]).score("anything") > 0.7
    assert quality.fit_chain(x, [0]).score("anything") < 0.3
    assert quality.fit_chain([], []).score("") == 0.5


def measured(df, spark, label):
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = df.join(truth, "doc_id").where("held_out").collect()
    return sum(r["predicted"] == r[label] for r in rows) / len(rows), df.count()


def test_quality_on_held_out_rows(spark):
    accuracy, n = measured(quality.op4_quality(spark, SF), spark, "quality")
    assert accuracy > 0.95 and n == 1000


def test_toxicity_on_held_out_rows(spark):
    accuracy, n = measured(toxicity.op6_toxicity(spark, SF), spark, "toxic")
    assert accuracy > 0.9 and n == 1000


@pytest.fixture
def odd(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "plain text."), (3, "WORD!! " * 50_000), (4, "you idiot scum")]
    return spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, score string")


def test_scores_of_odd_rows(spark, odd):
    chain = quality.fitted(spark, SF)
    scored = quality.score_quality(odd, chain)
    rows = scored.collect()
    assert scored.columns == odd.columns and len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality.score_quality(odd.limit(0), chain).collect() == []
    model = toxicity.Ensemble({}, np.full((1, 1), -1.0))
    assert {round(r["score"], 6) for r in toxicity.score_toxicity(odd, model).collect()} == {0.268941}


def test_nnpu_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(1)
    make = lambda n, p: (rng.random((n, 20)) < p).astype(np.float32)
    # Five marks at 0.8 against 0.05: two marks or more decide, which 0.993 of the toxic rows have.
    toxic = lambda n: np.hstack([make(n, 0.8)[:, :5], make(n, 0.1)[:, 5:]])
    clean = lambda n: make(n, 0.05)
    w = toxicity.fit_nnpu(toxic(300), np.vstack([toxic(100), clean(900)]), 0.1, seed=0)
    say = lambda x: x @ w[:-1] + w[-1] > 0
    assert say(toxic(500)).mean() > 0.9 and say(clean(500)).mean() < 0.05


@pytest.mark.parametrize("prior", [0.05, 1.5])  # the second term of the risk is above zero at the start, and below it
def test_a_step_of_the_non_negative_risk_follows_its_gradient(prior):
    rng = np.random.default_rng(4)
    p, u = (rng.random((40, 6)) < 0.7).astype(float), (rng.random((90, 6)) < 0.3).astype(float)
    rate = 1e-3
    w = toxicity.fit_nnpu(p, u, prior, seed=3, epochs=1, batch=len(u), rate=rate, decay=0.0)
    again = np.random.default_rng(3)
    again.permutation(len(u))
    xp, xu = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))
    xp = xp[again.integers(0, len(p), len(p))]
    start = np.zeros(7)
    start[-1] = -1.0
    loss = lambda z: 1 / (1 + np.exp(z))
    below = lambda v: loss(-(xu @ v)).mean() - prior * loss(-(xp @ v)).mean()
    assert (below(start) < 0) == (prior > 1)
    risk = (lambda v: -below(v)) if below(start) < 0 else (lambda v: prior * loss(xp @ v).mean() + below(v))
    slope = np.array([(risk(start + h) - risk(start - h)) / 2e-5 for h in 1e-5 * np.eye(7)])
    steep = np.abs(slope) > 1e-4
    assert steep.sum() >= 4
    assert np.array_equal(np.sign(start - w)[steep], np.sign(slope)[steep])
    assert np.allclose(np.abs(start - w)[steep], rate, rtol=1e-3)  # the first step of the optimiser has this length


def test_labels_of_odd_rows(spark):
    """Null ids and labels, an id with both labels, repeated ids, null texts."""
    docs = spark.createDataFrame(
        [(i + 1000 * (i > 19), "fine words in a good text. " * 3) for i in range(220)] + [(100 + i, "BAD ### $$$ !!! " * 5) for i in range(20)]
        + [(0, None), (0, "again fine words."), (None, "nobody"), (200, None)], "doc_id long, text string"
    )
    rows = [(i, 1, 0) for i in range(20)] + [(100 + i, 0, 1) for i in range(20)] + [(None, 1, 1), (200, None, None), (5, 0, 0), (7, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    chain = quality.train(docs, labels)
    assert chain.score("fine words in a good text.") > 0.7 > 0.3 > chain.score("BAD ### $$$ !!!")
    assert quality.train(docs, labels, max_lines=3).score("x") >= 0
    model = toxicity.train(docs, labels)
    assert model.score("bad bad", {}) > model.score("fine words", {})


def test_training_without_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, none).score("anything", {}) < 0.5
    assert quality.train(docs, none).score("anything") == 0.5
    assert toxicity.train(docs.limit(0), none.union(spark.createDataFrame([(1, 1, 1)], none.schema))).score("x", {}) < 0.5


def test_folds(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", quality.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert spark.createDataFrame([(None,)], "doc_id long").select(quality.held_out().alias("h")).first()["h"] is False
