"""Exact near-duplicate join on word shingles with adaptive multi-match prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import WordHasher, bitmap, flagged, maybe_in, mix, read, shingles, stored, tidied

#: Prefixes are kept for 1 to this many shared tokens.
LEVELS = 4
#: Cells of the frequency sketch, and the slices in which it travels.
CELLS, SLICES = 1 << 21, 64
#: Entries of one token beyond which its list is split by salt.
LONG_LIST = 200_000


def shingle_set(texts: list[bytes], k: int, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of A-Z-lowered texts, each split at ASCII white space."""
    found = [shingles(hasher(text.lower().split()), k) for text in texts]
    return np.unique(found[0] if len(found) == 1 else np.concatenate(found))


def _needed(n: np.ndarray | int, num: int, den: int):
    """Least overlap of a set of ``n`` with any set that it links to."""
    return -(-num * n // den)


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of each document, one by one."""
    for texts in column.cast(pa.list_(pa.binary())):
        yield [t or b"" for t in texts.as_py()]


def _by_id(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, texts)``, one row per id, and ``(id, count)`` of the ids that rows repeat; only rows of such ids are brought together."""
    repeated = stored(known.groupBy("id").count().where("count > 1"), "neardup-repeated")
    alone = F.array("text").alias("texts")
    if repeated.isEmpty():
        return known.select("id", alone), repeated
    maybe = flagged(bitmap(repeated, "id"), "id")
    several = known.where(maybe).groupBy("id").agg(F.collect_set(F.coalesce("text", F.lit(""))).alias("texts"))
    return known.where(~maybe).select("id", alone).unionByName(stored(several, "neardup-several")), repeated


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(11)) % np.uint64(CELLS)


def _survey(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (id, set size, set signature), and slices of the tasks' frequency sketches."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hasher, cells, waiting, held = WordHasher(), np.zeros(CELLS, dtype=np.uint32), [], 0
        for batch in batches:
            sizes, signs = [], []
            for text in _texts(batch.column(1)):
                tokens = shingle_set(text, k, hasher)
                sizes.append(len(tokens))
                signs.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                waiting.append(tokens)
                held += len(tokens)
                if held > 1_000_000:
                    cells += np.bincount(_cell(np.concatenate(waiting)).astype(np.int64), minlength=CELLS).astype(np.uint32)
                    waiting, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()), pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())],
                ["id", "n", "sign", "slice", "cells"],
            )
        if held:
            cells += np.bincount(_cell(np.concatenate(waiting)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        parts = [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(cells.reshape(SLICES, -1)) if p.any()]
        none = pa.nulls(len(parts), pa.int64())
        blank = pa.nulls(len(parts), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [none, none, blank, pa.array([i for i, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())],
            ["id", "n", "sign", "slice", "cells"],
        )

    return stored(docs.mapInArrow(tidied(survey), "id long, n long, sign binary, slice int, cells binary"), "neardup-survey")


def _sketch(survey: DataFrame) -> np.ndarray:
    """Frequencies of all shingles by cell: CELLS numbers whatever the input."""
    width = CELLS // SLICES

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.uint64)
        for part in table.column("cells"):
            total += np.frombuffer(zlib.decompress(part.as_py()), dtype=np.uint32)
        least = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32)
        return pa.table({"slice": table.column("slice").slice(0, 1), "cells": pa.array([zlib.compress(least.tobytes(), 1)], pa.binary())})

    rows = (
        survey.where("slice is not null").select("slice", "cells")
        .groupBy("slice").applyInArrow(add, "slice int, cells binary").collect()
    )
    out = np.zeros(CELLS, dtype=np.uint32)
    for row in rows:
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["cells"]), dtype=np.uint32)
    return out


def _entries(docs: DataFrame, nodes: np.ndarray, sketch: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """Prefix tokens of the documents in ``nodes``: (token, salt, id, pos, n).

    Tokens are in one order for all documents: estimated frequency, then hash; ``pos`` is the place in the document's own
    order. ``salt`` is 0 where the token's list is whole, and 1 or more where it is split: then other salts may hold the token as well.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()

        def out(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            token, salt, ids, pos, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), *[pa.array(x) for x in (salt, ids, pos, n)]], ["token", "salt", "id", "pos", "n"]
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.nonzero(maybe_in(nodes, ids))[0]
            parts, held = [], 0
            for i, text in zip(at, _texts(batch.column(1).take(pa.array(at))), strict=True):
                tokens = shingle_set(text, k, hasher)
                n = len(tokens)
                if not n:
                    continue
                often = sketch[_cell(tokens).astype(np.int64)]
                first = n - int(_needed(n, num, den)) + 1
                size = min(n, first + LEVELS - 1)
                order = np.lexsort((tokens, often))[:size]
                pieces = often[order] // LONG_LIST + 1
                salt = (mix(ids[i : i + 1].view(np.uint64))[0] % pieces.astype(np.uint64)).astype(np.int32)
                salt = np.where(pieces > 1, salt + 1, 0).astype(np.int32)
                same = lambda x, size=size: np.full(size, x, dtype=np.int32)
                parts.append((tokens[order], salt, np.full(size, ids[i]), np.arange(size, dtype=np.int32), same(n)))
                held += size
                if held > 200_000:
                    yield out(parts)
                    parts, held = [], 0
            if parts:
                yield out(parts)

    return docs.mapInArrow(tidied(entries), "token long, salt int, id long, pos int, n int")


def _sets(docs: DataFrame, nodes: np.ndarray, k: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.nonzero(maybe_in(nodes, ids))[0]
            texts = batch.column(1).take(pa.array(at))
            for start in range(0, len(at), 500):
                found = [shingle_set(t, k, hasher).tobytes() for t in _texts(texts.slice(start, 500))]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[start : start + 500]]), pa.array(found, pa.binary())], ["id", "tokens"])

    return docs.mapInArrow(tidied(sets), "id long, tokens binary")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(verify, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id of its connected part.

    Each round hooks every node to its smallest neighbour, follows the hooks twice, and rewrites
    the links between what is left, so the links shrink until none remains. Everything stays in stored tables.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = stored(
        links.select(F.col("a").alias("id")).union(links.select("b")).distinct().withColumn("component", F.col("id")), "labels"
    )
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up"))
        hooks = stored(hooks.select(F.col("a").alias("id"), "up"), "hooks")
        for _ in range(2):
            over = hooks.select(F.col("id").alias("up"), F.col("up").alias("over"))
            hooks = stored(hooks.join(over, "up").select("id", F.col("over").alias("up")), "hooks")
        to = lambda df, c: (
            df.join(hooks.select(F.col("id").alias(c), F.col("up").alias("_up")), c, "left")
            .withColumn(c, F.coalesce("_up", c)).drop("_up")
        )
        labels = stored(to(labels, "component").select("id", "component"), "labels")
        links = stored(to(to(links, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return labels


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: tuple[int, int] = (80, 100)
) -> DataFrame:
    """Per document its set size and the smallest id that it reaches by links.

    Words are runs without ASCII white space, A-Z lowered. A set holds the distinct ``k``-word shingles, or
    the whole sequence if it is shorter; shingles are 64-bit hashes. Two documents link when den *
    intersection >= num * union for ``similarity`` = (num, den).

    1. A pass finds each set's size and signature and adds up a frequency sketch of fixed size. Equal
       signatures form a class, and its smallest id stands for it.
    2. Each class emits its rarest shingles. To share l tokens with any set it links to, it needs
       n - ceil(similarity * n) + l of them; a token's level is the l at which it enters. Tokens of one document drop out, and
       so do tokens whose place leaves too little: what is shared before it, itself and what follows.
    3. From the exact lengths of its tokens' lists each document chooses the l (1 to 4) with the least
       estimated cost: list entries to read, plus candidates (at most entries / l) to verify.
    4. Within a list every document is first paired with the list's leader only, the document with the most company;
       verified pairs give components. Then only pairs of different components are formed, between those outside a list's largest component and the
       rest of the list. A pair with l shared tokens is verified on its full sets. So no link
       between components is lost, and groups of near copies need no pairs among themselves.

    Returns id, n_shingles and component_id for every row. A null or wordless text has an empty set and links with nothing. A null
    id is kept with a null component and the size of its own set. Rows that repeat an id are one document, whose set is the union of the rows'
    sets (the rows of an id are brought together for it); each row of it is returned. Other
    columns are ignored; no rows give no rows. Lists of very frequent tokens are split by salt; bitmaps
    (2 MB) and the sketch (8 MB) are all that is broadcast.
    """
    num, den = similarity
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known, repeated = _by_id(docs.where("id is not null"))
    survey = _survey(known.unionByName(docs.where("id is null").select("id", F.array("text").alias("texts"))), k)
    rows = survey.where("slice is null").select("id", "n", "sign")
    classes = stored(rows.where("sign is not null and id is not null").groupBy("sign").agg(F.min("id").alias("rep")), "neardup-classes")
    nodes = bitmap(classes, "rep")
    entries = _entries(known, nodes, _sketch(survey), k, num, den)

    # Tokens of one document alone drop out; of a split list, a salt does not tell, and the exact length below does.
    within = Window.partitionBy("token", "salt").orderBy("id")
    alone = F.lead("id").over(within).isNull() & F.lag("id").over(within).isNull() & (F.col("salt") == 0)
    shared = entries.withColumn("alone", alone).where("not alone").drop("alone")
    # What a token's place leaves possible: the tokens before it that are shared at all, itself, and those behind it.
    of_doc = Window.partitionBy("id")
    needed = lambda n: F.ceil(n * num / F.lit(den))
    shared = shared.withColumn("seen", F.row_number().over(of_doc.orderBy("pos"))).withColumn("rest", F.col("n") - 1 - F.col("pos"))
    shared = stored(shared.where(F.col("seen") + F.col("rest") >= needed(F.col("n"))), "neardup-shared")
    length = stored(shared.groupBy("token").agg(F.count("*").alias("length")).where("length > 1"), "neardup-lengths")

    level = F.greatest(F.lit(1), F.col("pos") - (F.col("n") - needed(F.col("n")) + 1) + 2)
    priced = shared.join(length, "token").withColumn("level", level.cast("int"))
    read_of = lambda l: F.sum(F.when(F.col("level") <= l, F.col("length") - 1).otherwise(0)).over(of_doc)
    cost = lambda l: read_of(l) * (1 + F.col("n") / (8.0 * l))
    most = F.greatest(F.lit(1), F.least(F.lit(LEVELS), needed(F.col("n")))).cast("int")
    priced = priced.withColumn("costs", F.array(*[cost(l) for l in range(1, LEVELS + 1)])).withColumn("weight", read_of(LEVELS))
    able = F.slice("costs", 1, most)
    priced = priced.withColumn("need", F.array_position(able, F.array_min(able)).cast("int"))
    # Leaders: per list (token, salt) the document whose tokens have the longest lists, the most typical one.
    me = F.struct(*[F.col(c) for c in ("id", "n", "seen", "rest")])
    typical = [F.desc("weight"), F.xxhash64("id"), F.col("id")]
    tokens = stored(
        priced.withColumn("lead", F.first(me).over(Window.partitionBy("token", "salt").orderBy(*typical)))
        .select("token", "id", "n", "seen", "rest", "need", "weight", "lead"),
        "neardup-tokens",
    )

    def possible(x: str, y: str, need: Column) -> Column:
        """Sizes fit, both tokens lie within the prefix for l = ``need``, and their places leave enough overlap.

        For two given sizes the least overlap is known exactly, so the prefixes are shorter than for one size alone.
        """
        f = lambda side, c: F.col(f"{side}.{c}")
        low, high = F.least(f(x, "n"), f(y, "n")), F.greatest(f(x, "n"), f(y, "n"))
        overlap = F.ceil((f(x, "n") + f(y, "n")) * num / F.lit(num + den))
        upto = F.least(f(x, "seen"), f(y, "seen")) + F.least(f(x, "rest"), f(y, "rest"))
        return (low * den >= high * num) & (F.least(f(x, "rest"), f(y, "rest")) + need >= overlap) & (upto >= overlap)

    def counted(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a", "b").agg(F.count("*").alias("hits"), F.first("need").alias("need")).where("hits >= need").select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "neardup-pairs")
        ids = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id")
        sets = stored(_sets(known, ids, k), "neardup-sets", "none")
        return stored(_verified(pairs, sets, num, den), "neardup-links")

    x = F.struct("id", "n", "seen", "rest").alias("x")
    star = tokens.where("id <> lead.id").select("token", x, F.col("lead").alias("y"), "need")
    top = F.first(me).over(Window.partitionBy("token").orderBy(*typical))
    split = tokens.where("id = lead.id").withColumn("y", top).where("id <> y.id").select("token", x, "y", "need")
    pairs = counted(star.unionByName(split).where(possible("x", "y", F.col("need"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "need"))
    first_links = verified(pairs)
    labels = components(first_links)

    labelled = tokens.drop("lead", "weight").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = stored(labelled, "neardup-labelled")
    groups = labelled.groupBy("token", "component").agg(F.count("*").alias("size"))
    mixed = groups.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component"))["component"].alias("main"))
    mixed = stored(mixed.where("parts > 1").select("token", "main"), "neardup-mixed")
    open_lists = stored(labelled.join(mixed, "token").withColumn("outside", F.col("component") != F.col("main")), "neardup-open")
    a_first = F.col("p.id") < F.col("o.id")
    need = F.when(a_first, F.col("p.need")).otherwise(F.col("o.need"))
    crossing = open_lists.where("outside").alias("p").join(
        open_lists.alias("o"),
        (F.col("p.token") == F.col("o.token"))
        & (F.col("p.component") != F.col("o.component"))
        & (~F.col("o.outside") | a_first)
        & possible("p", "o", need),
    ).select(F.least("p.id", "o.id").alias("a"), F.greatest("p.id", "o.id").alias("b"), need.alias("need"))
    second_links = verified(counted(crossing))
    labels = components(first_links.unionByName(second_links))

    rep_of = rows.where("sign is not null and id is not null").join(classes, "sign").select("id", "n", "rep")
    found = rep_of.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "id", "n", F.coalesce("component", "rep").alias("component")
    )
    rest = rows.where("sign is null or id is null").select("id", "n", F.col("id").alias("component"))
    out = found.unionByName(rest)
    if not repeated.isEmpty():
        counted_ids = out.join(repeated, "id", "left").withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("count", F.lit(1)))))
        out = counted_ids.select("id", "n", "component")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words
  from documents
), s as (
  select distinct doc_id, unnest(case when len(words) between 1 and 4 then [array_to_string(words, ' ')]
         else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
  from w
), n as (select doc_id, count(*) as n from s group by doc_id),
both_ways as (
  select a.doc_id as a, b.doc_id as b, count(*) as both_n from s as a join s as b using (shingle)
  where a.doc_id <> b.doc_id group by 1, 2
), links as (
  select a, b from both_ways join n as x on x.doc_id = a join n as y on y.doc_id = b
  where 100 * both_n >= 80 * (x.n + y.n - both_n)
), reach as (
  select doc_id, doc_id as far from documents
  union select reach.doc_id, links.b from reach join links on links.a = reach.far
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.component_id
from documents as d left join n using (doc_id)
join (select doc_id, min(far) as component_id from reach group by doc_id) as r using (doc_id)
"""
