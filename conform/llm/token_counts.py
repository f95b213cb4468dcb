"""Token counts of a byte-level BPE from pieces per distinct pre-token."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import by_bucket, pack_words, partitions, read, squeeze, stored, tidied, unpack_words, unsqueeze

#: Text bytes of a block of documents; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
# A blank between two characters that are no white space always starts a pre-token.
_ODD_BLANK = re.compile(r"(?<!\S) | (?!\S)")
_CUT = re.compile(r"(?<=\S)(?= \S)")
# Letters and marks of which every version of the character tables says the same.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,!?;:|#%&*$]*)")


def _chunks(text: str) -> Counter[str]:
    """How often each chunk between such blanks occurs; chunks keep their blank."""
    if not text:
        return Counter()
    if _ODD_BLANK.search(text) is None:
        first, *rest = text.split(" ")
        out = Counter({" " + w: n for w, n in Counter(rest).items()})
        out[first] += 1
        return out
    return Counter(_CUT.split(text))


class Block:
    """Pre-token frequencies of a run of documents, over a vocabulary of their own."""

    def __init__(self, pre_tokenize, specials: list[str], buckets: int) -> None:
        self.pre_tokenize, self.specials, self.buckets = pre_tokenize, specials, buckets
        self.split = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        self.chunks: dict[str, int] = {}
        self.doc: list[int] = []
        self.chunk: list[int] = []
        self.count: list[int] = []
        self.ids: list[int | None] = []
        self.n_bytes: list[int] = []
        self.n_special: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str, size: int) -> None:
        special = 0
        if self.split is not None and any(s in text for s in self.specials):
            parts = self.split.split(text)
            special = len(parts) - 1
            found: Counter[str] = Counter()
            for part in parts:
                found.update(_chunks(part))
        else:
            found = _chunks(text)
        known = self.chunks
        self.chunk.extend([known.setdefault(c, len(known)) for c in found])
        self.count.extend(found.values())
        self.doc.append(len(found))
        self.ids.append(doc_id)
        self.n_bytes.append(size)
        self.n_special.append(special)
        self.size += size

    def _pre_tokens(self, chunk: str) -> list[str]:
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            return [p for p in plain.groups() if p]
        return [chunk[a:b] for _, (a, b) in self.pre_tokenize(chunk)]

    def rows(self, block: int) -> dict[str, object]:
        known: dict[str, int] = {}
        of_chunk = [[known.setdefault(p, len(known)) for p in self._pre_tokens(c)] for c in self.chunks]
        place, parts = by_bucket(list(known), self.buckets)
        sizes = np.array([len(x) for x in of_chunk], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        flat = place[np.array([p for x in of_chunk for p in x], dtype=np.int64)] if len(known) else place
        chunk, count = np.array(self.chunk, dtype=np.int64), np.array(self.count, dtype=np.int64)
        doc = np.repeat(np.arange(len(self.doc)), self.doc)
        width = sizes[chunk] if len(chunk) else chunk
        which = np.repeat(starts[chunk] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum()) if len(chunk) else chunk
        key = np.repeat(doc, width) * max(1, len(known)) + flat[which]
        keys, inverse = np.unique(key, return_inverse=True)
        total = np.bincount(inverse, weights=np.repeat(count, width)).astype(np.int64) if len(keys) else keys
        per_doc = np.bincount(keys // max(1, len(known)), minlength=len(self.doc))
        pre_token = keys % max(1, len(known))
        first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
        delta = np.diff(pre_token, prepend=0)
        delta[first[per_doc > 0]] = pre_token[first[per_doc > 0]]
        return {
            "block": block, "ids": self.ids, "n_bytes": self.n_bytes, "n_special": self.n_special,
            "entries": squeeze(per_doc), "pre_tokens": squeeze(delta), "counts": squeeze(total),
            "vocabulary": [{"bucket": b, "words": pack_words(w)} for b, w in parts],
        }


def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """UTF-8 bytes and tokens of every whole text, as the ``tokenizers`` file at ``tokenizer`` counts them.

    No begin, end or template tokens are added; a special token's string inside a text is that one
    token, the library's default. The file must hold a byte-level BPE without normaliser, whose pre-tokens depend on nothing
    before them.

    1. Documents are taken in blocks of ``block_bytes``; each keeps its documents' pre-token frequencies over a
       vocabulary of its own, stored as packed numbers.
    2. The vocabularies travel in packed lists by hash bucket, so that equal pre-tokens meet; each
       distinct one is tokenised once and only its number of pieces is kept.
    3. The numbers go back to their blocks, where frequency times pieces is added up per document.

    A very frequent pre-token is one entry per block. Returns id, n_bytes, n_tokens and over_limit for every
    row, also for repeated ids. A null text counts as empty (no bytes, no tokens); a null id
    stays null. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    buckets = max(256, 4 * partitions(spark))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = _load(tokenizer)
        specials = [t.content for t in tok.get_added_tokens_decoder().values()]
        fresh = lambda: Block(tok.pre_tokenizer.pre_tokenize_str, specials, buckets)
        base, n, block = TaskContext.get().partitionId() << 32, 0, fresh()
        schema = pa.schema([
            ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("n_special", pa.list_(pa.int64())),
            ("entries", pa.binary()), ("pre_tokens", pa.binary()), ("counts", pa.binary()),
            ("vocabulary", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))),
        ])
        for batch in batches:
            for doc_id, size, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block.ids and block.size + size > block_bytes:
                    yield pa.RecordBatch.from_pylist([block.rows(base + n)], schema)
                    n, block = n + 1, fresh()
                block.add(doc_id, text or "", size)
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.rows(base + n)], schema)

    text = F.col(text_col)
    blocks = stored(
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"), text.alias("text")).mapInArrow(
            tidied(pack),
            "block long, ids array<long>, n_bytes array<long>, n_special array<long>, entries binary, pre_tokens binary, "
            "counts binary, vocabulary array<struct<bucket:int,words:binary>>",
        ),
        "tokens-blocks", "none",
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = _load(tokenizer), {}
        for batch in batches:
            out = []
            for packed in batch.column(2).to_pylist():
                words = unpack_words(packed)
                unknown = [w for w in words if w not in known]
                if len(known) + len(unknown) > 1_000_000:
                    known, unknown = {}, words
                for w, encoded in zip(unknown, tok.encode_batch_fast(unknown, add_special_tokens=False), strict=True):
                    known[w] = len(encoded)
                out.append(squeeze(np.array([known[w] for w in words], dtype=np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["block", "bucket", "pieces"])

    vocabulary = blocks.select("block", F.explode("vocabulary").alias("v")).select("block", "v.bucket", "v.words")
    counted = vocabulary.repartition(partitions(spark), "bucket").mapInArrow(pieces, "block long, bucket int, pieces binary")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
        parts = sorted(zip(right.column("bucket").to_pylist(), right.column("pieces").to_pylist(), strict=True))
        n = np.concatenate([np.empty(0, dtype=np.uint32), *[unsqueeze(p) for _, p in parts]]).astype(np.int64)
        tables = []
        for row in left.to_pylist():
            per_doc = unsqueeze(row["entries"]).astype(np.int64)
            delta, count = unsqueeze(row["pre_tokens"]).astype(np.int64), unsqueeze(row["counts"]).astype(np.int64)
            doc = np.repeat(np.arange(len(per_doc)), per_doc)
            running = np.cumsum(delta)
            first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
            before = np.where(first > 0, running[np.maximum(first - 1, 0)], 0) if len(running) else first * 0
            pre_token = running - before[doc]
            sums = np.bincount(doc, weights=count * n[pre_token], minlength=len(per_doc)) if len(doc) else np.zeros(len(per_doc))
            tokens = sums.astype(np.int64) + np.array(row["n_special"], dtype=np.int64)
            tables.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(tokens)], schema=out))
        return pa.concat_tables(tables) if tables else out.empty_table()

    postings = blocks.drop("vocabulary")
    summed = postings.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(add_up, "id long, n_bytes long, n_tokens long")
    return summed.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
