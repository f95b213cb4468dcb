"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_near_dup import brute

import corpus_pipeline as cp
from conform.llm import quality, secrets, tiling

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        out.append((docs, cp.stored(stage(spark, docs, SF), "test-stage")))
        docs = out[-1][1]
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]
    assert all(after.columns == before.columns for before, after in stages[:-1])


def test_quality_stage(spark, stages):
    before, after = stages[0]
    chain = quality.fitted(spark, SF)
    assert set(rows(after)) == {i for i, r in rows(before).items() if chain.score(r["text"] or "") >= cp.KEEP_FROM}


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    found = brute([(i, r["text"]) for i, r in rows(before).items()])
    assert set(rows(after)) == {i for i, (_, c) in found.items() if i == c}


def test_benchmark_stage(spark, stages):
    before, after = stages[2]
    items = [tiling.tokens_of(r["text"], tiling.WordHasher()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [x for x in items if len(x) >= 5]

    def leaks(text):
        doc = tiling.tokens_of(text, tiling.WordHasher())
        return any(sum(t[2] for t in tiling.tiles(x, doc, 5)) / len(x) >= 0.6 for x in items)

    assert set(rows(after)) == {i for i, r in rows(before).items() if not leaks(r["text"])}


def test_secret_stage(stages):
    before, after = rows(stages[3][0]), rows(stages[3][1])
    live = {r["doc_id"]: r["live"] for r in secrets.scan_secrets(stages[3][0]).collect()}
    for i, r in before.items():
        text = r["text"]
        for x in sorted(live[i], key=lambda x: -x["start"]):
            text = text[: x["start"]] + "[secret]" + text[x["end"] :]
        assert after[i]["text"] == text and after[i]["n_chars"] == len(text)


def test_encoding_stage(stages):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = rows(stages[4][0]), rows(stages[4][1])
    assert {i: (r["ids"], r["round_trip"]) for i, r in after.items()} == {i: (model.encode(r["text"]), True) for i, r in before.items()}


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, _score string, key int, n int, __sha string, __live int"


def odd(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "a", "b", 1, 2, "c", 3) for i, t, s in rows], ODD).repartition(3)


def prose(stem, n=40):
    return " ".join(f"{stem}{i}" for i in range(n)) + "."


def test_repeated_and_null_ids_keep_unrelated_texts(spark):
    rows = [(1, prose("a"), "s"), (1, prose("b"), "s"), (2, prose("c"), "s"), (3, prose("c"), "s"), (None, prose("c"), "s"), (None, prose("d"), "s"),
            (None, prose("d"), "s"), (None, prose("d", 39) + " x", "s"), (4, None, "s"), (4, None, "s"), (5, "", "s"), (1, prose("a"), "s")]
    kept = cp.keep_one_per_group(spark, odd(spark, rows), SF)
    assert kept.columns == odd(spark, rows).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    d = [x for x in got if x[0] is None]
    assert len(d) == 1 and d[0][1].startswith("d0 ")
    assert [x for x in got if x[0]] == [(1, prose("a")), (1, prose("b")), (2, prose("c")), (4, None), (5, "")]


def test_leaks_are_dropped_row_by_row(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, item, "s"), (1, prose("a"), "s"), (None, item, "s"), (None, prose("b"), "s"), (2, None, "s"), (3, f"{prose('c')} {item}", "s")]
    kept = cp.drop_benchmark(spark, odd(spark, rows), SF)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, prose("a")), (None, prose("b")), (2, None)], key=repr)


def test_clashing_columns_and_empty_tables_pass_every_stage(spark):
    rows = [(i, prose(f"w{i}x", 60) + "\ntoken=abcdef123456", f"s{i}") for i in range(5)] + [(None, None, None)]
    for name, stage in cp.STAGES[:-1]:
        for given in (odd(spark, rows), odd(spark, rows).limit(0)):
            out = stage(spark, cp.stored(given, "odd"), SF)
            assert out.columns == given.columns, name
            assert out.count() <= given.count()
    masked = cp.mask_secrets(spark, odd(spark, rows), SF).where("doc_id = 1").first()
    assert masked["__sha"] == "c" and masked["__live"] == 3


def test_texts_reach_workers_in_bounded_batches(spark, monkeypatch):
    seen = []
    before = spark.conf.get(cp.BATCH, None)

    def watch(spark, docs, sf_dir):
        sizes = docs.mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
        seen.append(max(r["n"] for r in sizes.collect()))
        return docs

    texts = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("long text "), 500).alias("text"))
    monkeypatch.setattr(cp, "read", lambda spark, sf_dir, name: texts)
    monkeypatch.setattr(cp, "STAGES", [("watched", cp.in_small_batches(watch))])
    assert cp.run(spark, "").count() == 3_000
    assert seen[0] < 2 * cp.BATCH_BYTES  # 15 MB of text were one batch
    assert spark.conf.get(cp.BATCH, None) == before
