"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import WordHasher, bitmap, maybe_in, mix, read, stored, texts_of, tidied

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Scripts that write no blanks between words (Thai, Lao, Myanmar, Khmer, Japanese, Chinese).
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def running_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` tokens: each follows from running sums in constant time."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens) * _powers(_BASE, len(tokens)), dtype=np.uint64)])
    return mix((sums[size:] - sums[:-size]) * _powers(_INVERSE, n))


def tokens_of(text: str | None, hasher: WordHasher) -> np.ndarray:
    """32-bit hashes of the words: lower case, split at white space and ASCII marks; in scripts without blanks, a character is a word."""
    text = (text or "").lower()
    if _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", text)
    words = text.encode("utf-8", "surrogatepass").translate(_SEPARATE).split()
    return (hasher(words) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def seeds_of(tokens: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Hashes of all windows of some sizes; windows of different sizes differ."""
    return np.concatenate([np.empty(0, dtype=np.int64), *[mix(running_hashes(tokens, n) + np.uint64(n)).view(np.int64) for n in sizes]])


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length), longest first.

    Windows of ``least`` tokens with equal running hashes, lined up by diagonal, give all maximal matches. The longest match that
    touches no marked token is marked, ties by place; a match that is partly marked goes back as
    its unmarked parts of ``least`` tokens or more.
    """
    of_item = running_hashes(item, least)
    of_doc = running_hashes(doc, least)
    order = np.argsort(of_item, kind="stable")
    low = np.searchsorted(of_item[order], of_doc, side="left")
    high = np.searchsorted(of_item[order], of_doc, side="right")
    at = np.nonzero(high > low)[0]
    if not len(at):
        return []
    counts = high[at] - low[at]
    j = np.repeat(at, counts)
    i = order[np.concatenate([np.arange(a, b) for a, b in zip(low[at], high[at], strict=True)])]
    same = (item[i] == doc[j]) & (item[i + least - 1] == doc[j + least - 1])
    i, j = i[same], j[same]
    by_diagonal = np.lexsort((i, j - i))
    i, j = i[by_diagonal], j[by_diagonal]
    if not len(i):
        return []
    starts = np.nonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)]))[0]
    ends = np.concatenate([starts[1:], [len(i)]])
    queue = [(-(int(b - a) + least - 1), int(i[a]), int(j[a])) for a, b in zip(starts, ends, strict=True)]
    heapq.heapify(queue)
    item_marked, doc_marked = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    out = []
    while queue:
        length, x, y = heapq.heappop(queue)
        length = -length
        marked = item_marked[x : x + length] | doc_marked[y : y + length]
        if not marked.any():
            item_marked[x : x + length] = True
            doc_marked[y : y + length] = True
            out.append((x, y, length))
            continue
        edges = np.diff(np.concatenate([[True], marked, [True]]).astype(np.int8))
        for a, b in zip(np.nonzero(edges == -1)[0], np.nonzero(edges == 1)[0], strict=True):
            if b - a >= least:
                heapq.heappush(queue, (-int(b - a), x + int(a), y + int(a)))
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", least: int = 5, coverage: float = 0.6, short_chars: int = 12, bits: int = 1 << 26,
) -> DataFrame:
    """Pairs of a document and a benchmark item of which tiles cover ``coverage`` or more.

    Words are lower case, split at white space and ASCII marks; in scripts without blanks a character is a word. Seeds are windows of ``least`` words. A
    bitmap of the items' seeds (fixed size) thins the documents' seeds in one pass; what passes meets the
    items' seeds in an equi-join. A pair with fewer seeds than tiles of the wanted coverage must have is dropped;
    the others are tiled over both whole word sequences, so moved and reordered passages count. An item of fewer words is one seed and must occur
    whole; with fewer than ``short_chars`` characters besides it is left out, as it cannot be told from chance.

    Returns the id, the item, ``coverage`` (share of the item's words that are tiled), ``n_tiles``, ``longest`` and ``text_sha`` (SHA-256 of the
    document's text, which tells rows apart that have one id or none). Each row is judged by itself, those with a null id too, and equal results are
    given once. Null or empty texts match nothing; items with a null id or text are left out. Empty tables give no rows; other columns are ignored.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item is not null")
    documents = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def split_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = list(texts_of(batch.column(1)))
            words = [tokens_of(t, hasher) for t in texts]
            fits = [len(w) >= least or (len(w) > 0 and len(t.strip()) >= short_chars) for w, t in zip(words, texts, strict=True)]
            seeds = [seeds_of(w, [min(len(w), least)]) if f else [] for w, f in zip(words, fits, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([len(w) if f else 0 for w, f in zip(words, fits, strict=True)], pa.int64()), pa.array(seeds, pa.list_(pa.int64()))],
                ["item", "words", "n", "seeds"],
            )

    items = items.mapInArrow(tidied(split_items), "item long, words binary, n long, seeds array<long>").where("n > 0")
    items = stored(items, "tiling-items")
    item_seeds = items.select("item", "n", F.explode("seeds").alias("seed"))
    wanted = bitmap(item_seeds, "seed", bits)
    sizes = sorted(r["size"] for r in items.select(F.least("n", F.lit(least)).alias("size")).distinct().collect())  # ``least`` at most

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids, words, found, keys = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                tokens = tokens_of(text, hasher)
                seeds = seeds_of(tokens, sizes)
                hits = np.unique(seeds[maybe_in(wanted, seeds)])
                if len(hits):
                    ids.append(i)
                    words.append(tokens.tobytes())
                    found.append(hits)
                    keys.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(keys, pa.string())],
                ["id", "doc_words", "seeds", "text_sha"],
            )

    seeded = documents.mapInArrow(tidied(seed), "id long, doc_words binary, seeds array<long>, text_sha string")
    seeded = stored(seeded.withColumn("row", F.monotonically_increasing_id()), "tiling-seeded")
    pairs = (
        seeded.select("row", F.explode("seeds").alias("seed")).join(item_seeds, "seed")
        .groupBy("row", "item", "n").agg(F.count("*").alias("hits"))
        .where((F.col("hits") * least >= F.col("n") * coverage) | (F.col("n") < least))
    )
    both = (
        stored(pairs.select("row", "item"), "tiling-pairs")
        .join(items.select("item", "words"), "item")
        .join(seeded.select("row", "id", "doc_words", "text_sha"), "row")
        .select("id", "item", "words", "doc_words", "text_sha")
    )

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share, count, longest = [], [], []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                item, doc = np.frombuffer(a.as_py(), dtype=np.uint32), np.frombuffer(b.as_py(), dtype=np.uint32)
                found = tiles(item, doc, min(len(item), least))
                share.append(sum(t[2] for t in found) / len(item))
                count.append(len(found))
                longest.append(max((t[2] for t in found), default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(share, pa.float64()), pa.array(count, pa.int64()), pa.array(longest, pa.int64()), batch.column(4)],
                ["id", "item", "coverage", "n_tiles", "longest", "text_sha"],
            )

    judged = both.mapInArrow(tidied(tile), "id long, item long, coverage double, n_tiles long, longest long, text_sha string")
    return judged.where(F.col("coverage") >= coverage).distinct().select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "coverage", "n_tiles", "longest", "text_sha"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
