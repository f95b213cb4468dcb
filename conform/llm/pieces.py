"""SentencePiece encoding and decoding over a relational lattice of distinct words."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import by_bucket, give_back, pack_words, partitions, read, squeeze, texts_of, tidied, unpack_words, unsqueeze

BLOCK_BYTES = 4 << 20
#: Words of more characters are merged one by one, as their lattice does not fit a 64-bit mask.
LONG_WORD = 62
#: Where a word stands in a block's vocabulary.
_REF = np.dtype([("block", "<i8"), ("bucket", "<i4"), ("place", "<i4")])
_SPACE = "▁"
_CHUNK = re.compile(r" *[^ ]+| +").findall
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model; blanks stand for the model's space mark."""

    ids: dict[str, int]  # normal pieces
    rank: dict[str, int]  # merge order of the pieces of two or more characters, or descending score
    scores: dict[str, float]
    byte_ids: tuple[int, ...]  # of the 256 bytes, or empty
    unknown: int
    kind: str  # "bpe" or "unigram"
    prefix: bool
    cut: str  # pattern of the words

    @property
    def longest(self) -> int:
        return max((len(p) for p in self.ids), default=1)


def load(path: str) -> Pieces:
    """The piece table in a model file. Only models without normalisation rules are taken, and only if no
    piece goes on after a blank, as words are then independent of each other."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rules, kind = proto.normalizer_spec, {1: "unigram", 2: "bpe"}.get(proto.trainer_spec.model_type)
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or kind is None:
        raise ValueError("the model normalises text or is neither BPE nor unigram")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, bytes_ = {}, {}, []
    for i, p in enumerate(proto.pieces):
        if p.type == pb.ModelProto.SentencePiece.BYTE:
            bytes_.append(i)
        elif p.type == pb.ModelProto.SentencePiece.NORMAL:
            text = p.piece.replace(_SPACE, " ")
            ids[text], scores[text] = i, p.score
        elif p.type == pb.ModelProto.SentencePiece.USER_DEFINED:
            raise ValueError("the model has user-defined pieces")
    if any(" " in p.lstrip(" ") for p in ids):
        raise ValueError("a piece of the model goes on after a blank")
    return table(ids, scores, tuple(bytes_), model.unk_id(), kind, rules.add_dummy_prefix)


def table(ids: dict[str, int], scores: dict[str, float], byte_ids=(), unknown: int = 0, kind: str = "bpe", prefix: bool = True) -> Pieces:
    order = {s: r for r, s in enumerate(sorted({scores[p] for p in ids}, reverse=True))}
    rank = {p: order[scores[p]] for p in ids if len(p) > 1}
    # Between a Latin letter and a mark that no piece puts beside one, a word may be cut.
    letter = re.compile(f"[{_LETTERS}]")
    beside = {c for p in ids for a, b in zip(p, p[1:]) for c, d in ((a, b), (b, a)) if letter.match(d)}
    m = re.escape("".join(c for c in _MARKS if c not in beside)) or "\0"
    alone = "" if any("\n" in p and len(p) > 1 for p in ids) else "\n"
    cut = rf" *[{_LETTERS}]++(?=[ {alone}{m}]|\Z)| *[{m}]++(?=[ {alone}{_LETTERS}]|\Z)| *[^ {alone}]+| +" + (f"|{alone}" if alone else "")
    return Pieces(ids, rank, scores, byte_ids, unknown, kind, prefix, cut)


def merge(word: str, rank: dict[str, int]) -> list[str]:
    """Pair merges of one word, best rank first, leftmost first, in n log n; for words beyond the mask."""
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    queue: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n:
            r = rank.get(word[a : end[b]])
            if r is not None:
                heapq.heappush(queue, (r, a, b, end[b]))

    for a in range(n):
        offer(a)
    while queue:
        _, a, b, c = heapq.heappop(queue)
        if not alive[a] or end[a] != b or b >= n or not alive[b] or end[b] != c:
            continue
        alive[b], end[a] = False, c
        if c < n:
            before[c] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    return [word[a : end[a]] for a in range(n) if alive[a]]


def best_path(word: str, pieces: Pieces) -> list[str]:
    """Highest sum of scores of one word; for words beyond the mask."""
    low = min(pieces.scores.values(), default=0.0) - 10
    best: list[tuple[float, int]] = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - pieces.longest), e):
            p = pieces.scores.get(word[s:e], low if e - s == 1 else None)
            if p is not None and best[s][0] + p > best[e][0]:
                best[e] = (best[s][0] + p, s)
    out, e = [], len(word)
    while e:
        s = best[e][1]
        out.append(word[s:e])
        e = s
    return out[::-1]


class Block:
    """Words of a run of documents as numbers of a vocabulary of their own.

    Texts are split at blanks first, which is fast, and only different chunks are cut into words. A block that is not
    ``numbered`` has the same vocabulary and keeps nothing of its documents.
    """

    def __init__(self, cut: re.Pattern, prefix: bool, buckets: int, numbered: bool = True) -> None:
        self.cut, self.prefix, self.buckets, self.numbered = cut.findall, prefix, buckets, numbered
        self.spaced: dict[str, int] = {}  # chunks behind one blank, without it
        self.other: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.hashes: list[int] = []
        self.chunks: list[np.ndarray] = []  # below 0: of the other chunks
        self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        text = text.replace(_SPACE, " ")
        self.ids.append(doc_id)
        self.size += len(text)
        plain = self.prefix and "  " not in text and text[:1] != " " and text[-1:] != " "
        if not self.numbered:
            if text:
                known = self.spaced if plain else self.other
                known.update(dict.fromkeys(text.split(" ") if plain else _CHUNK((" " if self.prefix else "") + text), 0))
            return
        if not text:
            found: list[int] = []
        elif plain:
            known = self.spaced
            found = [known.setdefault(c, len(known)) for c in text.split(" ")]
        else:
            known = self.other
            found = [-1 - known.setdefault(c, len(known)) for c in _CHUNK((" " if self.prefix else "") + text)]
        self.chunks.append(np.array(found, dtype=np.int64))
        self.hashes.append(zlib.crc32(text.encode("utf-8", "surrogatepass")))

    def vocabulary(self) -> tuple[list[list[int]], np.ndarray, list[tuple[int, list[str]]], int]:
        """Words of each chunk, their places in bucket order, the buckets' words, and a check sum."""
        known: dict[str, int] = {}
        # Letters and digits alone, of any script, are one word whatever the pattern: it cuts at blanks, line breaks and ASCII marks.
        words = [
            [known.setdefault(" " + c, len(known))] if c.isalnum() else [known.setdefault(w, len(known)) for w in self.cut(" " + c)] for c in self.spaced
        ]
        words += [[known.setdefault(w, len(known)) for w in self.cut(c)] for c in self.other]
        place, parts = by_bucket(list(known), self.buckets)
        check = 0
        for _, w in parts:
            check = zlib.crc32("\0".join(w).encode("utf-8", "surrogatepass"), check)
        return words, place, parts, check

    def numbers(self, words: list[list[int]], place: np.ndarray) -> tuple[bytes, bytes]:
        """Words per document, and the place of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = place[np.array([n for w in words for n in w], dtype=np.int64)] if len(place) else np.empty(0, dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        chunk = np.concatenate([*self.chunks, np.empty(0, dtype=np.int64)])
        chunk = np.where(chunk < 0, len(self.spaced) - 1 - chunk, chunk)
        width = sizes[chunk]
        ends = np.cumsum(width)
        take = np.repeat(starts[chunk] - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.concatenate([[0], ends])[np.cumsum([0, *[len(c) for c in self.chunks]])]
        return squeeze(np.diff(upto)), squeeze(flat[take])


def _blocks(docs: DataFrame, pieces: Pieces, buckets: int, block_bytes: int) -> DataFrame:
    """Blocks of documents, cut once: a row with the documents of a block as word numbers, ``key`` being the block, and a row with
    each bucket of its vocabulary, ``key`` being the bucket."""
    cut, prefix = pieces.cut, pieces.prefix
    schema = pa.schema([
        ("key", pa.int64()), ("block", pa.int64()), ("words", pa.binary()),
        ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("hashes", pa.list_(pa.int64())), ("numbers", pa.binary()),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n, pattern = TaskContext.get().partitionId() << 32, 0, re.compile(cut)

        def rows(block: Block) -> Iterator[pa.RecordBatch]:
            import xxhash

            # The key says what the vocabulary is: if one of two runs of a task cuts a block differently, its rows do not meet the other's.
            words, place, parts, check = block.vocabulary()
            key = xxhash.xxh3_64_intdigest(f"{base + n}:{check}") >> 1
            yield pa.RecordBatch.from_pylist([{"key": b, "block": key, "words": pack_words(w)} for b, w in parts], schema)
            lengths, numbers = block.numbers(words, place)
            yield pa.RecordBatch.from_pylist(
                [{"key": key, "block": key, "ids": block.ids, "lengths": lengths, "hashes": block.hashes, "numbers": numbers}], schema
            )

        block = Block(pattern, prefix, buckets)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                if block.ids and block.size + len(text) > block_bytes:
                    yield from rows(block)
                    n, block = n + 1, Block(pattern, prefix, buckets)
                block.add(doc_id, text)
        if block.ids:
            yield from rows(block)

    return docs.mapInArrow(
        tidied(pack), "key long, block long, words binary, ids array<long>, lengths binary, hashes array<long>, numbers binary"
    )


def merged(ends: np.ndarray, owner: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The masks of words after all merges of BPE.

    ``mask`` has a bit for every boundary of a word, an edge of ``ends`` the two bits of its ends. An edge fits if both are there and one
    boundary lies between them. The edges of a word (``owner``) follow each other by rank and start; each round applies the first one that
    fits in every word, and drops words without one and edges that do not fit any more.
    """
    mask = mask.copy()
    inner = ends - (ends & -ends) * 3  # of the bits s and e: those from s + 1 to e - 1
    while len(ends):
        now = mask[owner]
        within = now & inner
        left = ((now & ends) == ends) & (within != 0)
        fits = np.nonzero(left & ((within & (within - 1)) == 0))[0]
        if not len(fits):
            break
        first = fits[np.concatenate([[True], owner[fits[1:]] != owner[fits[:-1]]])]
        mask[owner[first]] &= ~inner[first]
        changed = np.zeros(len(mask), dtype=bool)
        changed[owner[first]] = True
        left &= changed[owner]
        left[first] = False
        ends, inner, owner = ends[left], inner[left], owner[left]
    return mask


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """The edges (s, e, rank or score) of the pieces in ``words`` (word, refs), those of a word in a row behind a head row with s = -1 that carries the word itself.

    All substrings from two characters (one, for unigram models) up to the longest piece that begins as they do are exploded and meet the
    piece table in an equi-join on their hash, checked on the text (a model's table has a fixed size and is broadcast).
    """
    spark = words.sparkSession
    bpe = pieces.kind == "bpe"
    value, least = ("rank", 2) if bpe else ("score", 1)
    entries = [(p, pieces.rank[p] if bpe else pieces.scores[p]) for p in (pieces.rank if bpe else pieces.ids)]
    longest = {"": 0}
    for p, _ in entries:
        longest[p[:least]] = max(longest.get(p[:least], 0), len(p))

    def known(rows: list[tuple], column: str, kind: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame(rows, f"known string, {column} {kind}").withColumn("key", F.xxhash64("known")))

    # A join on the hash alone is one on longs. Equality as two prefixes keeps the text out of the join's key.
    same = (F.xxhash64("part") == F.col("key")) & F.col("part").startswith(F.col("known")) & F.col("known").startswith(F.col("part"))
    n, s, head = F.length("word"), F.col("s"), F.col("s") < 0
    text = lambda size: F.when(head, F.lit("")).otherwise(F.coalesce(F.col("word").substr(s + 1, size), F.lit("")))
    last = F.when(n <= LONG_WORD, F.greatest(n - least, F.lit(-1))).otherwise(F.lit(-1))
    rows = words.select("word", "refs", F.explode(F.sequence(F.lit(-1), last)).alias("s")).withColumn("part", text(F.lit(least)))
    rows = rows.join(known([*longest.items()], "most", "int"), same)
    ends = F.when(head, F.array(F.lit(-1))).otherwise(F.sequence(s + least, F.least(n, s + F.col("most"))))
    rows = rows.select("word", "refs", "s", F.explode(ends).alias("e"))
    rows = rows.select(F.when(head, F.col("word")).alias("word"), F.when(head, F.col("refs")).alias("refs"), "s", "e", text(F.col("e") - s).alias("part"))
    rows = rows.join(known([*entries, ("", -1 if bpe else 0.0)], value, "int" if bpe else "double"), same)
    return rows.select("word", "refs", "s", "e", value)


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of :func:`lattice` in runs of whole words, and the places of their heads."""
    kept: list[pa.RecordBatch] = []
    heads = lambda rows: np.nonzero(rows.column("s").to_numpy() < 0)[0]
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) < 100_000:
            continue
        whole = pa.Table.from_batches(kept)
        at = heads(whole)
        if len(at) > 1:
            yield whole.slice(0, int(at[-1])), at[:-1]
            kept = whole.slice(int(at[-1])).to_batches()
    if kept:
        whole = pa.Table.from_batches(kept)
        yield whole, heads(whole)


def _fold_merges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with ``mask``: bit i set where a piece of the BPE encoding begins or ends at character i; null for words beyond the mask."""
    for rows, heads in _by_word(batches):
        s, e, rank = (rows.column(c).to_numpy().astype(np.int64) for c in ("s", "e", "rank"))
        owner = np.cumsum(s < 0) - 1
        own = s >= 0
        s, e, rank, owner = s[own], e[own], rank[own], owner[own]
        order = np.argsort(owner << 38 | rank << 6 | s, kind="stable")
        s, e, owner = s[order], e[order], owner[order]
        word, refs = (rows.column(c).take(pa.array(heads)).combine_chunks() for c in ("word", "refs"))
        sizes = np.array([len(w) for w in word.to_pylist()], dtype=np.int64)
        one, short = np.int64(1), sizes <= LONG_WORD
        every = (one << np.where(short, sizes, 0) + 1) - 1
        mask = merged(one << s | one << e, owner, every)
        yield pa.RecordBatch.from_arrays([word, refs, pa.array(mask, mask=~short)], ["word", "refs", "mask"])


def _best_paths(edges: DataFrame, pieces: Pieces) -> DataFrame:
    """Words with ``mask``, as :func:`_fold_merges` gives it, for unigram models: a fold over the edges of a word, grouped without a shuffle,
    takes each end's best incoming edge."""
    low = min(pieces.scores.values(), default=0.0) - 10

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in _by_word(batches):
            s, e, score = (rows.column(c).to_numpy() for c in ("s", "e", "score"))
            owner = np.cumsum(s < 0) - 1
            own = s >= 0
            s, e, score, owner = s[own], e[own].astype(np.int64), score[own], owner[own]
            order = np.lexsort((s, e, owner))
            s, e, score, owner = s[order], e[order], score[order], owner[order]
            offsets = np.searchsorted(owner, np.arange(len(heads) + 1)).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(e), pa.array(s), pa.array(score)], ["end", "start", "score"])
            words = [rows.column(c).take(pa.array(heads)).combine_chunks() for c in ("word", "refs")]
            yield pa.RecordBatch.from_arrays([*words, pa.ListArray.from_arrays(pa.array(offsets), parts)], ["word", "refs", "edges"])

    grouped = edges.mapInArrow(tidied(group), "word string, refs binary, edges array<struct<end:long,start:int,score:double>>")
    full = F.lit(1).cast("long")

    # State: best score of each end so far and the boundaries on its best path; ends come in order.
    def step(state: Column, e: Column) -> Column:
        unknown = F.struct(
            (F.element_at(state["best"], e)["score"] + low).alias("score"),
            F.element_at(state["best"], e)["mask"].bitwiseOR(F.call_function("shiftleft", full, e)).alias("mask"),
        )
        coming = F.transform(
            F.filter("edges", lambda x: x["end"] == e),
            lambda x: F.struct(
                (F.element_at(state["best"], x["start"] + 1)["score"] + x["score"]).alias("score"),
                F.element_at(state["best"], x["start"] + 1)["mask"].bitwiseOR(F.call_function("shiftleft", full, e)).alias("mask"),
            ),
        )
        return F.struct(F.array_append(state["best"], F.greatest(F.array_max(coming), unknown)).alias("best"))

    start = F.struct(F.array(F.struct(F.lit(0.0).alias("score"), full.alias("mask"))).alias("best"))
    folded = F.aggregate(F.sequence(F.lit(1), F.length("word")), start, step, lambda s: F.element_at(s["best"], -1)["mask"])
    return grouped.select("word", "refs", F.when(F.length("word") <= LONG_WORD, folded).alias("mask"))


def encode(
    docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, decoded: bool = False
) -> DataFrame:
    """The piece ids of every whole text, as the SentencePiece library gives them without begin or end pieces.

    Words (runs that no piece crosses) are encoded once each over the corpus, over the edges of :func:`lattice`:

    1. Documents are taken in blocks and cut once. A block's documents become numbers of its distinct words; these travel in packed
       lists by hash bucket, where equal words of different blocks meet. A very frequent word is one entry per block. Both kinds of rows go
       through one shuffle, which Spark reads twice.
    2. Fold over the edges: for BPE, each round applies the first edge by rank and start that joins exactly two current symbols; for unigram models,
       each step takes an end's best incoming edge.
    3. The encoded words go back to their blocks, where each document's words are replaced by their ids.

    Characters that no piece holds become their byte pieces (the unknown piece, if the model has none). Returns id, ``ids`` (array) and ``text_hash``
    (CRC-32 of the text as it can be decoded) for every row, with ``decoded`` also ``decoded_hash``, that of the text that the ids decode to; a null text is an empty one and has no ids; null and repeated ids stay as they are. If a
    lost executor makes Spark read ``docs`` again in part, it must give the same rows in the same order, as a stored table does; otherwise
    blocks do not find their words and the job fails. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    buckets = max(256, 4 * partitions(spark))
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Both readers take every column, so that Spark plans this shuffle once.
    dealt = _blocks(given, pieces, buckets, block_bytes).repartition("key")

    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.filter(rows.column("words").is_valid())
        of: dict[str, int] = {}
        found, sizes = [], []
        for packed in rows.column("words").to_pylist():
            known = unpack_words(packed)
            found += [of.setdefault(w, len(of)) for w in known]
            sizes.append(len(known))
        number, sizes = np.array(found, dtype=np.int64), np.array(sizes, dtype=np.int64)
        ref = np.empty(len(number), dtype=_REF)
        ref["block"], ref["bucket"] = np.repeat(rows.column("block").to_numpy(), sizes), np.repeat(rows.column("key").to_numpy(), sizes)
        ref["place"] = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ref = ref[np.argsort(number, kind="stable")]
        ends = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(of)))]) * _REF.itemsize
        refs = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ref.tobytes())])
        met = pa.table({"word": pa.array(list(of), pa.string()), "refs": refs})
        del of, found, number, ref, rows
        give_back()
        return met

    words = dealt.groupBy("key").applyInArrow(meet, "word string, refs binary")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the words, gathered per block and bucket."""
        of, chars = pieces.ids, {}

        def single(c: str) -> list[int]:
            found = chars.get(c)
            if found is None:
                i = of.get(c)
                found = chars[c] = [i] if i is not None else (
                    [pieces.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")] if pieces.byte_ids else [pieces.unknown]
                )
            return found

        def out() -> pa.RecordBatch:
            ref = np.frombuffer(b"".join(refs), dtype=_REF)
            which = np.repeat(np.arange(len(refs)), [len(r) // _REF.itemsize for r in refs])
            order = np.lexsort((ref["place"], ref["bucket"], ref["block"]))
            ref, which = ref[order], which[order]
            cuts = np.nonzero((np.diff(ref["block"]) != 0) | (np.diff(ref["bucket"]) != 0))[0] + 1
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            flat = np.array([i for x in ids for i in x], dtype=np.uint32)
            blocks, kept = [], []
            for at in np.split(np.arange(len(ref)), cuts):
                w = which[at]
                width = sizes[w]
                take = np.repeat(firsts[w] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
                blocks.append((int(ref["block"][at[0]]), int(ref["bucket"][at[0]])))
                kept.append((squeeze(ref["place"][at]), squeeze(width), squeeze(flat[take])))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in blocks], pa.int64()), pa.array([b for _, b in blocks], pa.int32()), *[pa.array([k[j] for k in kept], pa.binary()) for j in range(3)]],
                ["block", "bucket", "places", "widths", "pieces"],
            )

        refs: list[bytes] = []
        ids: list[list[int]] = []
        for batch in batches:
            for word, ref, mask in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mask is None:
                    parts = merge(word, pieces.rank) if pieces.kind == "bpe" else best_path(word, pieces)
                else:
                    bounds = [i for i in range(len(word) + 1) if mask >> i & 1]
                    parts = [word[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                found: list[int] = []
                for p in parts:
                    i = of.get(p) if len(p) > 1 else None
                    if i is not None:
                        found.append(i)
                    else:
                        for c in p:
                            found += single(c)
                refs.append(ref)
                ids.append(found)
            if len(refs) >= 20_000:
                yield out()
                refs, ids = [], []
        if refs:
            yield out()

    edges, types = lattice(words, pieces), "block long, bucket int, places binary, widths binary, pieces binary"
    if pieces.kind == "bpe":
        spelt = edges.mapInArrow(tidied(lambda batches: spell(_fold_merges(batches))), types)
    else:
        spelt = _best_paths(edges, pieces).mapInArrow(tidied(spell), types)

    fields = [("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text_hash", pa.int64()), *([("decoded_hash", pa.int64())] if decoded else [])]
    spelling = _spelling(pieces) if decoded else None

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema(fields)
        left = left.filter(left.column("numbers").is_valid())
        if not left.num_rows:  # a bucket of the vocabulary
            return schema.empty_table()
        buckets_, n = right.column("bucket").to_numpy(), right.num_rows
        places, widths, found = (
            [unsqueeze(x).astype(np.int64) for x in right.column(c).to_pylist()] for c in ("places", "widths", "pieces")
        )
        bucket = np.repeat(buckets_, [len(p) for p in places]) if n else np.empty(0, dtype=np.int64)
        place, width, flat = (np.concatenate([*x, np.empty(0, dtype=np.int64)]) for x in (places, widths, found))
        order = np.lexsort((place, bucket))
        starts = (np.concatenate([[0], np.cumsum(width)[:-1]]) if len(width) else width)[order]
        width = width[order]
        tables = []
        for row in left.to_pylist():
            numbers, lengths = unsqueeze(row["numbers"]).astype(np.int64), unsqueeze(row["lengths"]).astype(np.int64)
            if len(numbers) and not len(width):
                raise ValueError(f"block {row['block']} was cut differently when read again")
            w = width[numbers]
            ends = np.cumsum(w)
            take = np.repeat((starts[numbers] - (ends - w)).astype(np.int32), w)
            take += np.arange(len(take), dtype=np.int32)
            upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
            found = flat[take].astype(np.int32)
            del take, numbers, w, ends
            ids = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(found))
            columns = [pa.array(row["ids"], pa.int64()), ids, pa.array(row["hashes"], pa.int64())]
            if decoded:
                columns.append(pa.array(_decoded_hashes(found, upto, *spelling), pa.int64()))
            tables.append(pa.table(columns, schema=schema))
        give_back()
        return pa.concat_tables(tables) if tables else schema.empty_table()

    types = "id long, ids array<int>, text_hash long" + (", decoded_hash long" if decoded else "")
    encoded = dealt.groupBy("key").cogroup(spelt.groupBy("block")).applyInArrow(assemble, types)
    return encoded.select(F.col("id").alias(id_col), *encoded.columns[1:])


def _spelling(pieces: Pieces) -> tuple[list[bytes], bool]:
    """Bytes of every id, and whether a leading blank is the model's own."""
    spelt = {i: p.encode("utf-8") for p, i in pieces.ids.items()} | {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}
    return [spelt.get(i, b"") for i in range(max(spelt, default=-1) + 1)], pieces.prefix


def _decoded(ids: list[int], names: list[bytes], prefix: bool) -> str:
    most = len(names)
    text = b"".join([names[i] for i in ids if 0 <= i < most]).decode("utf-8", "replace")
    return text[1:] if prefix and text.startswith(" ") else text


def _decoded_hashes(ids: np.ndarray, upto: np.ndarray, names: list[bytes], prefix: bool) -> list[int]:
    """CRC-32 of :func:`_decoded` for each run of ids between two numbers of ``upto``."""
    of, out, upto = [*names, b""].__getitem__, [], upto.tolist()
    for a, b in zip(upto[:-1], upto[1:], strict=True):  # run by run, so that no list of all ids is held
        run = ids[a:b]
        data = b"".join(map(of, np.where((run >= 0) & (run < len(names)), run, len(names)).tolist()))
        text = data.decode("utf-8", "replace")
        out.append(zlib.crc32((text[1:] if prefix and text.startswith(" ") else text).encode("utf-8")))
    return out


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``out_col``: pieces in a row, byte pieces as bytes, the model's leading blank off.

    Null ids give a null text. An id outside the table gives nothing; bytes that are no UTF-8 give replacement characters.
    """
    names, prefix = _spelling(pieces)
    columns = [c for c in encoded.columns if c != out_col]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for ids in batch.column(ids_col):
                texts.append(_decoded(ids.values.to_pylist(), names, prefix) if ids.is_valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*columns, out_col])

    kept = encoded.select(columns)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(join, f"{types}, `{out_col}` string")


def encoded_documents(docs: DataFrame, model: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_pieces, ids, and whether the ids decode to the text. Smaller blocks take less memory and more shuffle, and give the same rows."""
    whole = encode(docs, load(model), block_bytes=block_bytes, decoded=True)
    return whole.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", (F.col("decoded_hash") == F.col("text_hash")).alias("round_trip"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
