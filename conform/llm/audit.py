"""Filter interaction audit: what each filter removes in every order, from one pass over the texts."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import read, stored, tidied
from conform.operators.joins import salted_join

#: Says whether a text, as UTF-8 bytes and as its words, fails a filter.
Test = Callable[[bytes, list[bytes]], bool]

MOST_FILTERS = 5  # 2 ** 5 subsets fill a word of 32 bits
HELD_PARTS = 10_000  # parts whose counts a task holds before it passes them on

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")


def _shouts(raw: bytes, words: list[bytes]) -> bool:
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return 100 * upper > 5 * len(raw.translate(None, _CONTINUATION))


TESTS: dict[str, Test] = {
    "A": lambda raw, words: len(words) < 50,
    "B": lambda raw, words: 100 * len(set(words)) < 65 * len(words),
    "C": _shouts,
    "D": lambda raw, words: _MARKS.search(raw) is not None,
}
#: The filter that needs the whole table: the text is that of a smaller id.
DUPLICATE = "E"


def failures(
    docs: DataFrame,
    tests: Mapping[str, Test] = TESTS,
    duplicate: str | None = DUPLICATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``row, id, part, failed``: for each row the set of failed filters, as bits in the order of ``tests``, ``duplicate`` last.

    Whole texts are tested; words are maximal runs without ASCII white space. A null text is an
    empty one, a null part the empty string. A row fails ``duplicate`` if a smaller id has the same text (by a
    128-bit digest, over the whole table); rows that repeat an id are not smaller than each other, and a row with a null id neither
    fails it nor makes others fail. Every row counts, repeated ones too. Other columns are ignored. No rows in, no rows out.

    The texts are read once; digests meet map-side first, and a text that a third of the rows share is spread in the join back.
    """
    letters = [*tests, *([duplicate] if duplicate else [])]
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} filters of different names, not {letters}")
    checks = list(tests.values())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed, digests = np.zeros(batch.num_rows, dtype=np.int32), []
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                raw = text.as_py() or b""
                words = raw.split()
                failed[i] = sum(check(raw, words) << bit for bit, check in enumerate(checks))
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(failed), pa.array(digests, pa.binary())], ["id", "part", "failed", "digest"]
            )

    judged = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(tidied(judge), "id long, part string, failed int, digest binary")
    # The number is stored with the row, so a task that runs again sends its rows to the same places.
    judged = stored(judged.withColumn("row", F.monotonically_increasing_id()), "audit-judged")
    if not duplicate:
        return judged.select("row", "id", "part", "failed")
    least = judged.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    least = stored(least.select("digest", "least"), "audit-copied")
    again = F.coalesce(F.col("id") > F.col("least"), F.lit(False)).cast("int") * (1 << len(tests))
    both = salted_join(judged, least, ["digest"], "left", salt_by=["row"])
    return both.select("row", "id", "part", (F.col("failed") + again).alias("failed"))


def survival_words(failed: DataFrame, filters: int) -> DataFrame:
    """The rows of :func:`failures` with ``word``: bit S is set if the row passes all filters of subset S."""
    full = range(1 << filters)
    words = [sum(1 << s for s in full if not s & f) for f in full]
    return failed.withColumn("word", F.get(F.array(*[F.lit(w).cast("long") for w in words]), F.col("failed")))


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many words have each bit set, by carry-save addition.

    A full adder takes three words to a sum word and a carry word of twice the weight, all bits at
    once; what is left is a few words a weight.
    """
    bits = np.arange(32, dtype=np.uint32)
    counts = np.zeros(32, dtype=np.int64)
    left, weight = words.astype(np.uint32), 1
    while len(left):
        carries = []
        while len(left) > 2:
            n = len(left) // 3
            a, b, c, rest = left[:n], left[n : 2 * n], left[2 * n : 3 * n], left[3 * n :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            left = np.concatenate([half ^ c, rest])
        counts += weight * ((left[:, None] >> bits) & 1).sum(axis=0).astype(np.int64)
        left, weight = np.concatenate(carries) if carries else left[:0], weight * 2
    return counts


def survivors(words: DataFrame, labels: Mapping[str, str], filters: int) -> DataFrame:
    """``part, subset, n`` and a count per label: the rows of a part that pass all filters of a subset, and those with each label.

    ``words`` has ``part``, ``word`` and the columns of ``labels`` (column -> name of its count), booleans where null is false.
    Each task adds its words up by part and combination of labels, so a part of any size costs a row a subset and task.
    """
    flags, full = list(labels), 1 << filters
    names = ["part", "subset", "n", *labels.values()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}  # part -> (1 + labels) x 32 counts

        def out() -> pa.RecordBatch:
            table = np.stack(list(held.values()))[:, :, :full] if held else np.zeros((0, 1 + len(flags), full), dtype=np.int64)
            columns = [pa.array([p for p in held for _ in range(full)], pa.string()), pa.array(np.tile(np.arange(full, dtype=np.int32), len(held)))]
            columns += [pa.array(table[:, j].ravel()) for j in range(1 + len(flags))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            word = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint32)
            group = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for j in range(len(flags)):
                flag = batch.column(2 + j).fill_null(False).to_numpy(zero_copy_only=False)
                group = group * 2 + flag.astype(np.int64)
            order = np.argsort(group, kind="stable")
            there, starts = np.unique(group[order], return_index=True)
            for g, own in zip(there.tolist(), np.split(word[order], starts[1:]), strict=True):
                part = parts.dictionary[g >> len(flags)].as_py()
                table = held.setdefault(part, np.zeros((1 + len(flags), 32), dtype=np.int64))
                counts = positional_counts(own)
                table[0] += counts
                for j in range(len(flags)):
                    if g >> (len(flags) - 1 - j) & 1:
                        table[1 + j] += counts
            if len(held) > HELD_PARTS:
                yield out()
        yield out()

    schema = ", ".join(["part string", "subset int", *[f"`{n}` long" for n in names[2:]]])
    counted = words.select("part", "word", *flags).mapInArrow(count, schema)
    return counted.groupBy("part", "subset").agg(*[F.sum(n).alias(n) for n in names[2:]])


def audit(counts: DataFrame, letters: str, labels: Mapping[str, str]) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of :func:`survivors`.

    ``labels`` maps the name of a label's count to the column of what is lost of it. A part's counts are
    one row a subset, from which every order follows: what a step removes is the survivors of the filters
    before it less those with its own.
    """
    places = range(len(letters))
    orders = list(itertools.permutations(places))
    steps = [(o, k, f, sum(1 << g for g in o[:k])) for o in orders for k, f in enumerate(o)]
    own = np.array([f for _, _, f, _ in steps])
    before = np.array([b for *_, b in steps])
    alone, full = 1 << own, (1 << len(letters)) - 1
    spelt = pa.array(["".join(letters[g] for g in o) for o, *_ in steps], pa.string())
    step = pa.array([k + 1 for _, k, *_ in steps], pa.int32())
    names = ["kept", "removed", "redundant", "unique_fails", *labels.values(), "shapley"]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by = {name: np.zeros(full + 1, dtype=np.int64) for name in ["n", *labels]}
                for cell in cells:
                    for name, table in by.items():
                        table[cell["subset"]] = cell[name]
                n = by["n"]
                removed = n[before] - n[before | alone]
                columns = [n[before | alone], removed, n[0] - n[alone] - removed, n[full ^ alone] - n[full]]
                columns += [by[name][before] - by[name][before | alone] for name in labels]
                share = np.zeros(len(letters), dtype=np.int64)
                np.add.at(share, own, removed)
                columns.append(share[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps), pa.string()), spelt, step, *[pa.array(c) for c in columns]],
                    ["part", "filter_order", "step", *names],
                )

    cells = F.collect_list(F.struct("subset", "n", *labels)).alias("cells")  # one a subset: 32 at most
    schema = ", ".join(["part string, filter_order string, step int", *[f"`{n}` long" for n in names]])
    return counts.groupBy("part").agg(cells).mapInArrow(expand, schema)


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    tests: Mapping[str, Test] = TESTS,
    duplicate: str | None = DUPLICATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """What each filter keeps and removes in each part, for every order of the filters.

    Every document becomes a word with a bit for each subset of the filters that it survives; the words are added
    up bit by bit in each task, by part and label, and all orders are read off the sums.

    ``labels`` has the id, ``quality`` and ``toxic``; an id is good (toxic) if any of its rows says 1. Documents without a label, or with a null
    id, are neither. Returns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``; see
    :func:`failures` for nulls, repeated rows and ties. No documents, no rows.
    """
    letters = "".join([*tests, *([duplicate] if duplicate else [])])
    words = survival_words(failures(docs, tests, duplicate, id_col, text_col, part_col), len(letters))
    marked = (
        labels.where(F.col(id_col).isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    )
    both = salted_join(stored(words, "audit-words"), marked, ["id"], "left", salt_by=["row"])
    counts = survivors(both, {"is_good": "good", "is_toxic": "toxic"}, len(letters))
    return audit(counts, letters, {"good": "good_lost", "toxic": "toxic_lost"})


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, coalesce(source, '') as part,
         min(doc_id) over (partition by coalesce(text, '')) as least,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id
), f as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         case when len(words) < 50 then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
         + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end
         + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
         + case when d.doc_id > least then 16 else 0 end as m
  from d left join l on d.doc_id = l.doc_id
), cells as (
  select part, m, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, m
), letters as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, b)
), orders as (
  select p1.letter || p2.letter || p3.letter || p4.letter || p5.letter as filter_order, [p1.b, p2.b, p3.b, p4.b, p5.b] as bs
  from letters p1 join letters p2 on p2.b <> p1.b join letters p3 on p3.b not in (p1.b, p2.b)
  join letters p4 on p4.b not in (p1.b, p2.b, p3.b) join letters p5 on p5.b not in (p1.b, p2.b, p3.b, p4.b)
), steps as (
  select filter_order, cast(step as integer) as step, bs[step] as b,
         cast(coalesce(list_sum(bs[:step - 1]), 0) as integer) as before
  from (select *, unnest(range(1, 6)) as step from orders)
), r as (
  select part, filter_order, step, b,
         cast(sum(case when m & (before | b) = 0 then n else 0 end) as bigint) as kept,
         cast(sum(case when m & before = 0 and m & b <> 0 then n else 0 end) as bigint) as removed,
         cast(sum(case when m & before <> 0 and m & b <> 0 then n else 0 end) as bigint) as redundant,
         cast(sum(case when m = b then n else 0 end) as bigint) as unique_fails,
         cast(sum(case when m & before = 0 and m & b <> 0 then good else 0 end) as bigint) as good_lost,
         cast(sum(case when m & before = 0 and m & b <> 0 then toxic else 0 end) as bigint) as toxic_lost
  from cells cross join steps group by part, filter_order, step, b
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, b) as bigint) as shapley
from r
"""
