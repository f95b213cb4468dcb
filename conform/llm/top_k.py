"""Exact top-k inner products with a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import read, stored, tidied
from conform.llm.hard_negatives import HIGH, LARGEST, LOW, integers, products
from conform.session import scratch_dir

#: Elements of one block of scores (queries x vectors) in a task.
BLOCK = 1 << 21


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, scale: float, n_queries: int):
    rows = max(1, BLOCK // max(1, n_queries))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part.column(0).to_numpy(zero_copy_only=False), integers(part.column(1), dim, scale)


# LOW is the score of an empty place of a list, and of a query's own row: below every score.


def _total(scores: list[np.ndarray]) -> np.ndarray:
    """The sum of the slices' scores, as the nearest long where it does not fit one; each slice's own already is."""
    total = scores[0]
    for s in scores[1:]:
        over = (s > 0) & (total > HIGH - np.maximum(s, 0))
        under = (s < 0) & (total < LOW - np.minimum(s, 0))
        with np.errstate(over="ignore"):
            total = np.where(over, HIGH, np.where(under, LOW, total + s))
    return total


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row, the positions of the k highest scores, in any order. ``~`` turns the order round as ``-`` does, without overflow at LOW."""
    return np.argpartition(~scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]


def _reaching(scores: list[np.ndarray], cutoff: np.ndarray) -> np.ndarray:
    """Which rows (queries x vectors) a slice sends and whose bound reaches the cutoff, given each slice's local scores."""
    share = cutoff // len(scores)  # never above cutoff / slices
    seen = [s >= share for s in scores]
    bound = _total([np.where(there, s, share) for there, s in zip(seen, scores, strict=True)])
    return np.any(seen, axis=0) & (bound >= cutoff)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    nodes: int = 2,
    chunk: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest integer inner product for each query.

    A component x counts as floor(scale * x). The components are dealt over ``nodes``
    slices; a slice's share of the inner product is its local score. For a chunk of queries:

    1. every slice gives its ``k`` highest local scores per task; the k-th highest full score
       among these rows is a floor under the final k-th score, the cutoff;
    2. the cutoff goes to all tasks (one number a query, ``chunk`` at most). A row whose
       local scores are all below cutoff / nodes cannot reach it; the others are collected;
    3. those are bounded by what is known of them, and the survivors' scores are computed in
       full. Each task passes on its best ``k`` per query.

    Vectors are never shuffled: a chunk of queries (``chunk`` rows) meets all vectors in a scan, its answers are stored, and
    the scans repeat for the next chunk; the plan does not grow with the chunks. A component beyond 2^62 counts as that, a
    score beyond a long as the nearest long (of its slices' sums). Returns query_id, rank from 1, vec_id and score; ties
    go to the smaller id. Rows with a null id, a null or empty vector, or a null or non-finite
    component take no part; a vector meets those of its own length. A query never finds rows
    with its own id; repeated rows each take a rank; a query id that is repeated counts once, with
    the smallest vector. No rows in, no rows out. Other columns are ignored.
    """

    def usable(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col)
        fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("v")).where(
            F.col("id").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & fine
        )

    spark = vectors.sparkSession
    base = usable(vectors).withColumn("dim", F.size("v"))
    asked = stored(usable(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "top-k-asked")
    paths = []
    for dim in [r["dim"] for r in asked.select("dim").distinct().collect()]:
        own = base.where(F.col("dim") == dim).select("id", "v")
        ask = asked.where(F.col("dim") == dim).select("id", "v").orderBy("id")
        after: int | None = None
        while True:
            rows = (ask if after is None else ask.where(F.col("id") > after)).limit(chunk).collect()
            if not rows:
                break
            after = rows[-1]["id"]
            found = _chunk(own, [r["id"] for r in rows], np.array([r["v"] for r in rows]), dim, k, scale, nodes)
            best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
            paths.append(scratch_dir(spark, "top-k"))
            ranked.select("query_id", "rank", "vec_id", "score").write.parquet(paths[-1])
            if len(rows) < chunk:
                break
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _local(q: np.ndarray, v: np.ndarray, slices: list[slice]) -> list[np.ndarray]:
    return [products(q[:, s], v[:, s]) for s in slices]


def _slices(dim: int, nodes: int) -> list[slice]:
    edges = np.linspace(0, dim, min(nodes, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _cutoffs(own: DataFrame, query_ids: np.ndarray, q: np.ndarray, k: int, scale: float, slices: list[slice]) -> np.ndarray:
    """Phase 1: per query the k-th highest full score among the rows that the slices list; LOW if they list fewer rows."""
    dim = q.shape[1]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The task's list of each slice, with the rows' full scores."""
        kept = [
            (np.full((len(q), k), LOW), np.full((len(q), k), LOW), np.full((len(q), k), -1, dtype=np.int64))
            for _ in slices
        ]
        for vec_ids, v in _blocks(batches, dim, scale, len(q)):
            scores = _local(q, v, slices)
            total, mine = _total(scores), query_ids[:, None] == vec_ids[None, :]
            for j, own_scores in enumerate(scores):
                s = np.where(mine, LOW, own_scores)
                top = _highest(s, k)
                pick = lambda x, top=top: np.take_along_axis(x, top, axis=1)
                s_all = np.hstack([kept[j][0], pick(s)])
                t_all = np.hstack([kept[j][1], pick(total)])
                i_all = np.hstack([kept[j][2], vec_ids[top]])
                keep = _highest(s_all, k)
                kept[j] = tuple(np.take_along_axis(x, keep, axis=1) for x in (s_all, t_all, i_all))
        for s, t, i in kept:
            row, col = np.nonzero(s > LOW)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[row]), pa.array(i[row, col]), pa.array(t[row, col])], ["q", "id", "total"]
            )

    lists = own.mapInArrow(tidied(gather), "q long, id long, total long").groupBy("q", "id").agg(F.max("total").alias("total"))
    kth = Window.partitionBy("q").orderBy(F.desc("total"), "id")
    cutoffs = {
        r["q"]: r["total"]
        for r in lists.withColumn("n", F.row_number().over(kth)).where(F.col("n") == k).select("q", "total").collect()
    }
    return np.array([cutoffs.get(int(i), LOW) for i in query_ids], dtype=np.int64)[:, None]


def _chunk(
    own: DataFrame, ids: list[int], asked: np.ndarray, dim: int, k: int, scale: float, nodes: int
) -> DataFrame:
    query_ids, q = np.array(ids, dtype=np.int64), np.clip(np.floor(scale * asked), -LARGEST, LARGEST)
    slices = _slices(dim, nodes)
    cutoff = _cutoffs(own, query_ids, q, k, scale, slices)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phases 2 and 3: rows that a slice sends, bounded, then scored in full."""
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def cut() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows, found, scores = (np.concatenate(x) for x in zip(*best, strict=True))
            order = np.lexsort((found, ~scores, rows))
            rows, found, scores = rows[order], found[order], scores[order]
            first = np.searchsorted(rows, rows, side="left")
            keep = np.arange(len(rows)) - first < k
            return rows[keep], found[keep], scores[keep]

        for vec_ids, v in _blocks(batches, dim, scale, len(q)):
            scores = _local(q, v, slices)
            row, col = np.nonzero(_reaching(scores, cutoff) & (query_ids[:, None] != vec_ids[None, :]))
            full = _total([s[row, col] for s in scores])
            keep = full >= cutoff[row, 0]
            best.append((row[keep], vec_ids[col[keep]], full[keep]))
            held += int(keep.sum())
            if held > 1_000_000:
                best[:] = [cut()]
                held = len(best[0][0])
        if best:
            row, found, score = cut()
            for at in range(0, len(row), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row[part]]), pa.array(found[part]), pa.array(score[part])],
                    ["query_id", "vec_id", "score"],
                )

    return own.mapInArrow(tidied(resolve), "query_id long, vec_id long, score long")


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.e, v.e) as bigint) as score
  from v as q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))
