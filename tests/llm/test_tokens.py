"""Token counts and piece encoding against the libraries, text by text."""

from __future__ import annotations

import itertools

import public_tokenizers
import pytest

from conform.llm import pieces as pc
from conform.llm.token_counts import token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", None, "a b", "<|endoftext|>", "a<|endoftext|> b  c\n\n d<|endoftext|>", "  lead", "trail  ", "a b 　 c",
    "don't  'll x's I'VE", "tab\t x\r\n y", "\x00a b\x1fc \x1f d", "1 2  3\n4 12345 3.14", "日本 語 テスト。 ok", "é ǘ x́y",
    "a b\u0085 c", "\U0001F600 \U0001F600x 5½ ⅷ ² a²", "▁x▁▁y", "x" * 200 + "y", "...,,,!?;:", "http://a.b/c?d=e&f",
    "a" * 61, "b" * 62, "c" * 63, " " * 70, "\n", "thethethethetheinging nº. ª", "one two three " * 5000,
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(2, "a b", "x", 1), (None, "null id", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")


@pytest.mark.parametrize("block", [20, 1 << 24])
def test_counts_equal_the_library(docs, block):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    got = token_counts(docs, JSON, limit=3, block_bytes=block).collect()
    want = sorted(
        (-1 if i is None else i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False)), n > 3)
        for i, t, *_ in docs.collect()
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want


def test_counts_of_an_empty_table(docs):
    assert token_counts(docs.limit(0), JSON).collect() == []


@pytest.mark.parametrize("block", [20, 1 << 24])
def test_pieces_equal_the_library_and_decode(docs, block):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = pc.load(MODEL)
    got = pc.decode(pc.encode(docs, pieces, block_bytes=block), pieces).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for i, text in [*enumerate(TEXTS), (None, "null id")]:
        assert by_id[i]["ids"] == model.encode(text or ""), repr(text)
        assert by_id[i]["text"] == (text or "").replace("▁", " ")


def test_pieces_of_an_empty_table(docs):
    pieces = pc.load(MODEL)
    assert pc.decode(pc.encode(docs.limit(0), pieces), pieces).collect() == []


def brute_unigram(word, pieces):
    low = min(pieces.scores.values()) - 10
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        bounds = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(bounds, bounds[1:])]
        if all(p in pieces.scores or len(p) == 1 for p in parts):
            score = sum(pieces.scores.get(p, low) for p in parts)
            best = max(best or (-1e9, []), (score, parts), key=lambda x: x[0])
    return best[1]


def test_unigram_fold_finds_the_best_path(spark):
    scores = {"a": -3.0, "b": -3.1, "ab": -4.0, "ba": -4.3, "abb": -5.05, " a": -2.5, "aba": -5.9, " ab": -4.21}
    pieces = pc.table({p: i + 1 for i, p in enumerate(scores)}, scores, kind="unigram", prefix=False)
    words = ["".join(w) for n in (1, 2, 3, 5, 6) for w in itertools.product("abc", repeat=n)][:400] + [" abba", " a"]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in pc.encode(docs, pieces).collect()}
    for i, word in enumerate(words):
        assert got[i] == [pieces.ids.get(p, 0) for p in brute_unigram(word, pieces)], word
    assert [pieces.ids.get(p, 0) for p in pc.best_path("ab" * 40, pieces)] == [3] * 40


def test_decode_of_odd_ids(spark):
    pieces = pc.load(MODEL)
    df = spark.createDataFrame([(1, [5, 999999, -1]), (2, None), (3, [])], "k long, ids array<int>")
    assert {r["k"]: r["text"] for r in pc.decode(df, pieces).collect()} == {1: "\x02", 2: None, 3: ""}


def test_a_block_without_numbers_has_the_same_vocabulary():
    import re

    pattern = re.compile(pc.table({"a": 0, "ab": 1, ".": 2}, {"a": 0.0, "ab": -1.0, ".": -2.0}).cut)
    texts = ["", "ab a, ab.c", " lead  two ", "x1 日本 é٣ a\nb a\tb ß²", "don't " * 3, "tail "]
    for prefix in (True, False):
        numbered, plain = pc.Block(pattern, prefix, 7), pc.Block(pattern, prefix, 7, False)
        for i, text in enumerate(texts):
            numbered.add(i, text)
            plain.add(i, text)
        (words, place, parts, check), (_, _, parts2, check2) = numbered.vocabulary(), plain.vocabulary()
        assert (parts, check) == (parts2, check2) and not plain.chunks and not plain.hashes
        chunks = [*(" " + c for c in numbered.spaced), *numbered.other]
        known = list(dict.fromkeys(w for c in chunks for w in pattern.findall(c)))
        assert [[known[i] for i in w] for w in words] == [pattern.findall(c) for c in chunks]


def test_texts_are_cut_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3).write.parquet(path)
    encoded = pc.encode(spark.read.parquet(path), pc.load(MODEL), block_bytes=50).groupBy().count()
    assert encoded.collect()[0][0] == len(TEXTS)
    plan = encoded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1  # the vocabulary was stored, and the texts read again


def test_the_fold_of_masks_merges_as_the_heap_does():
    import random

    import pyarrow as pa

    draw = random.Random(5)
    names = {"".join(draw.choice("ab ") for _ in range(draw.randint(2, 6))) for _ in range(60)}
    rank = {p: draw.randint(0, 25) for p in sorted(names)}  # ranks tie, and pieces rank before their parts
    rank = {p: r * 100 + i for i, (p, r) in enumerate(rank.items())}
    words = ["".join(draw.choice("abc ") for _ in range(draw.randint(0, 62))) for _ in range(400)] + ["ab" * 31, "a" * 62, "x" * 63]
    rows = []
    for i, w in enumerate(words):
        rows.append((w, str(i).encode(), -1, -1, -1))
        if len(w) <= pc.LONG_WORD:
            rows += [(None, None, s, e, rank[w[s:e]]) for s in range(len(w)) for e in range(s + 2, min(len(w), s + 6) + 1) if w[s:e] in rank]
    schema = pa.schema([("word", pa.string()), ("refs", pa.binary()), ("s", pa.int32()), ("e", pa.int32()), ("rank", pa.int32())])
    batches = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema).to_batches(max_chunksize=37)
    got = [r for b in pc._fold_merges(iter(batches)) for r in b.to_pylist()]
    assert [(r["word"], int(r["refs"])) for r in got] == [(w, i) for i, w in enumerate(words)]
    for r in got[:-1]:
        bounds = [i for i in range(len(r["word"]) + 1) if r["mask"] >> i & 1]
        assert [r["word"][a:b] for a, b in zip(bounds, bounds[1:])] == pc.merge(r["word"], rank)
    assert got[-1]["mask"] is None


def test_hashes_of_decoded_runs_equal_those_of_the_texts():
    import zlib

    import numpy as np

    names, ids = [b"", b" a", "é".encode(), b"\xc3", b"b", b" "], np.array([1, 2, 99, -1, 5, 1, 3, 4, 3, 0], dtype=np.int32)
    upto = np.array([0, 0, 4, 6, 6, 10])
    for prefix in (True, False):
        want = [zlib.crc32(pc._decoded(ids[a:b].tolist(), names, prefix).encode()) for a, b in zip(upto, upto[1:])]
        assert pc._decoded_hashes(ids, upto, names, prefix) == want
