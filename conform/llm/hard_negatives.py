"""Hard-negative mining over lists that clustered anchors share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import read, stored, tidied
from conform.session import scratch_dir

LIST_ROWS = 1 << 16  # rows of one stretch of a list, sorted and walked at a time
FIRST, CELLS = 64, 1 << 21  # entries of a walk's first step; scores (members x entries) of any step
SLACK = 1e-6  # radians; far above the error of an angle
LARGEST = float(1 << 62)  # a component counts as at most this
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """floor(scale * x) of each component, as doubles (whole numbers)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * flat.reshape(-1, dim)), -LARGEST, LARGEST)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact integers; a product that does not fit a long counts as the nearest long."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, LOW, HIGH).astype(np.int64)


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; a vector of length 0 has no direction and stays 0."""
    norms = np.linalg.norm(v, axis=1)
    return v / np.where(norms > 0, norms, 1)[:, None], norms


def spherical_kmeans(units: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """``cells`` unit centroids at most, from places spread evenly over the rows."""
    centroids = units[np.linspace(0, len(units) - 1, cells).astype(int)]
    for _ in range(rounds):
        nearest = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        moved, lengths = directions(sums)
        centroids = np.where(lengths[:, None] > 0, moved, centroids)
    return centroids


@dataclass
class Cluster:
    """Anchors that share a list, and what each asks of it: the ``k`` best scores from ``low`` to ``high``, any number of times."""

    vectors: np.ndarray  # members x dim, whole numbers
    ids: np.ndarray
    labels: np.ndarray  # places in the chunk's list of labels
    low: np.ndarray  # members x requests
    high: np.ndarray
    k: int
    same: bool  # rows of the member's own label are asked for, or those of the others
    first: int  # number of the cluster's first request in its chunk
    centroid: np.ndarray = field(init=False)
    spread: float = field(init=False)  # angle between the centroid and the member farthest from it
    norms: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        units, self.norms = directions(self.vectors)
        mean, length = directions(units.sum(axis=0, keepdims=True))
        self.centroid = mean[0]
        angles = np.arccos(np.clip(units @ self.centroid, -1, 1))
        self.spread = float(angles.max()) if length[0] > 0 else np.pi

    def bounds(self, units: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """An upper bound of each row's inner product with a member of length 1, wherever in the cluster it lies."""
        angle = np.arccos(np.clip(units @ self.centroid, -1, 1)) - self.spread - SLACK
        return norms * np.cos(np.maximum(0, angle))


class Walk:
    """What the members of a cluster hold of the list so far."""

    def __init__(self, cluster: Cluster) -> None:
        self.cluster, self.need = cluster, cluster.low.copy()
        self.requests, self.ids, self.scores = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.scored = 0

    def add(self, requests: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keep the best ``k`` of each request, ties by smaller id; the k-th is what a later entry needs."""
        requests, ids, scores = (np.concatenate(x) for x in ((self.requests, requests), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, ~scores, requests))
        requests, ids, scores = requests[order], ids[order], scores[order]
        place = np.arange(len(requests)) - np.searchsorted(requests, requests, side="left")
        kth, keep = place == self.cluster.k - 1, place < self.cluster.k
        flat = self.need.reshape(-1)
        flat[requests[kth]] = np.maximum(flat[requests[kth]], scores[kth])
        self.requests, self.ids, self.scores = requests[keep], ids[keep], scores[keep]

    def along(self, vectors: np.ndarray, units: np.ndarray, norms: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Sort a stretch of the list by its bounds once; each member walks it until no later entry can matter.

        A member is done when the next bound, and so every later score, is below what each of its requests needs.
        """
        c = self.cluster
        bounds = c.bounds(units, norms)
        order = np.argsort(-bounds, kind="stable")
        bounds = bounds[order]
        at, step = 0, FIRST
        while at < len(order):
            reach = np.maximum(bounds[at] * c.norms, bounds[at] * c.norms * (1 + 1e-9)) + 1e-3
            active = np.flatnonzero(((self.need <= reach[:, None]) & (c.low <= c.high)).any(axis=1))
            if not len(active):
                return
            step = max(FIRST, min(step, CELLS // len(active)))
            rows = order[at : at + step]
            scores = products(c.vectors[active], vectors[rows])
            self.scored += scores.size
            fits = (c.labels[active][:, None] == labels[rows][None, :]) == c.same
            fits &= c.ids[active][:, None] != ids[rows][None, :]
            hits = []
            for r in range(c.low.shape[1]):
                member, col = np.nonzero(fits & (scores >= self.need[active, r][:, None]) & (scores <= c.high[active, r][:, None]))
                hits.append((active[member] * c.low.shape[1] + r, ids[rows[col]], scores[member, col]))
            found = [np.concatenate(x) for x in zip(*hits, strict=True)]
            if len(found[0]):
                self.add(*found)
            at, step = at + step, 2 * step


def walk_all(vectors: DataFrame, clusters: list[Cluster], labels: list[str], dim: int, scale: float) -> DataFrame:
    """``request, id, score``: the best rows of each task for each request."""

    value_set = pa.array(labels, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [Walk(c) for c in clusters]

        def stretches() -> Iterator[list[pa.RecordBatch]]:
            held, rows = [], 0
            for batch in batches:
                for start in range(0, batch.num_rows, LIST_ROWS):
                    held.append(batch.slice(start, LIST_ROWS))
                    rows += held[-1].num_rows
                    if rows >= LIST_ROWS:
                        yield held
                        held, rows = [], 0
            if rows:
                yield held

        for held in stretches():
            v = np.concatenate([integers(b.column(2), dim, scale) for b in held])
            ids = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held])
            places = np.concatenate(
                [pc.fill_null(pc.index_in(b.column(1), value_set), -1).to_numpy(zero_copy_only=False) for b in held]
            )
            units, norms = directions(v)
            for walk in walks:
                walk.along(v, units, norms, ids, places)
        for walk in walks:
            columns = [walk.cluster.first + walk.requests, walk.ids, walk.scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["request", "id", "score"])

    return vectors.mapInArrow(tidied(run), "request long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """``found`` with its rank; the best ``k`` of each request."""
    order = Window.partitionBy("request").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


@dataclass
class _Chunk:
    """Anchors that meet the rows in one scan, cell by cell."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    cells: np.ndarray

    def clusters(self, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> list[Cluster]:
        """One cluster per cell, its members next to each other; request n of the chunk is the n-th of ``low``."""
        out = []
        for cell in np.unique(self.cells):
            at = np.flatnonzero(self.cells == cell)
            part = slice(at[0], at[-1] + 1)
            out.append(Cluster(self.vectors[part], self.ids[part], self.labels[part], low[part], high[part], k, same, int(at[0]) * low.shape[1]))
        return out


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    cells: int = 64,
    sample: int = 4096,
    chunk: int = 2048,
    thin: int = 16,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows of another label that score high, but not too high, against each anchor and each of its positives.

    A component x counts as floor(scale * x); a score is the integer inner product. An anchor's positives are its
    ``positives`` best rows of the same label; the negatives of an anchor and a positive of score p are the
    ``negatives`` best rows of other labels with ``low * p <= 100 * score <= high * p``. Higher scores come first, ties by smaller id.

    The anchors are clustered: ``cells`` spherical centroids at most, fitted on about ``sample`` of them (twice that at most), and every anchor goes
    to its nearest. For a cluster a list of the rows is sorted by the upper bound ``|row| cos(max(0, angle to the centroid - the cluster's
    spread))`` once, and every member walks it until the bound certifies that nothing later can enter any of its
    answers. The list lies in stretches over the tasks. So that tasks need not find out for themselves how good the
    answers are, one row in ``thin`` (by the hash of its id) is walked first: the scores found there are a floor under the
    final ones. Centroids, sample and floor only save work; the answers are exact.

    Rows are never shuffled. A chunk of about ``chunk`` anchors is scanned against all rows (twice, and twice against the thinned ones), its answers are
    stored, and the next one follows; the plan does not grow with the chunks. The driver holds one chunk.

    Returns ``anchor_id, positive_id, rank`` (from 1, among the negatives returned)``, negative_id, positive_score, negative_score``.
    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part; a vector
    meets those of its own length. Each row stands for itself: rows that repeat an id are each an anchor, a
    positive, a negative; rows with an anchor's own id are never its positives or negatives. A component beyond 2^62 counts
    as that, a score beyond a long as the nearest long. An anchor without a positive, or without a row in the range, has no
    rows in the result; no anchors, no rows. Other columns are ignored.
    """

    def usable(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col)
        fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        picked = df.select(
            F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vector.cast("array<double>").alias("v")
        )
        there = F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & fine
        return picked.where(there).withColumn("dim", F.size("v"))

    spark = vectors.sparkSession
    base = usable(vectors)
    asked = stored(usable(anchors).withColumn("at", F.monotonically_increasing_id()), "anchors")
    paths = []
    for dim in sorted(r["dim"] for r in asked.select("dim").distinct().collect()):
        rows = base.where(F.col("dim") == dim).select("id", "label", "v")
        thinned = rows.where(F.pmod(F.xxhash64("id"), F.lit(thin)) == 0)
        for part in _chunks(asked.where(F.col("dim") == dim), dim, scale, cells, sample, chunk):
            if part.num_rows:
                paths.append(_mine(rows, thinned, part, dim, scale, positives, negatives, low, high))
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def _chunks(asked: DataFrame, dim: int, scale: float, cells: int, sample: int, chunk: int) -> Iterator[list]:
    """The anchors with their cell, about ``chunk`` at a time: whole cells, or hashed shares of a large one."""
    every = -(-asked.count() // sample)
    some = asked.where(F.pmod(F.xxhash64("at"), F.lit(every)) == 0).limit(2 * sample).select("v").toArrow().column(0).combine_chunks()
    units, _ = directions(integers(some, dim, scale))
    centroids = spherical_kmeans(units, max(1, min(cells, len(units) // 4)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, _ = directions(integers(batch.column(2), dim, scale))
            cell = pa.array((own @ centroids.T).argmax(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], ["id", "label", "v", "at", "cell"])

    placed = asked.select("id", "label", "v", "at").mapInArrow(assign, "id long, label string, v array<double>, at long, cell int")
    placed = stored(placed, "anchor-cells")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    todo, room = [], 0
    for cell, size in sorted(sizes.items()):
        shares = -(-size // chunk)
        for share in range(shares):
            todo.append((F.col("cell") == cell) & (F.pmod(F.xxhash64("at"), F.lit(shares)) == share))
            room += size // shares
            if room >= chunk:
                yield _collected(placed, todo)
                todo, room = [], 0
    if todo:
        yield _collected(placed, todo)


def _collected(placed: DataFrame, conditions: list) -> pa.Table:
    """The rows of any of the conditions, by cell."""
    any_of = conditions[0]
    for condition in conditions[1:]:
        any_of |= condition
    return placed.where(any_of).orderBy("cell", "at").toArrow().combine_chunks()


def _mine(
    rows: DataFrame, thinned: DataFrame, part: pa.Table, dim: int, scale: float, positives: int, negatives: int, low: int, high: int
) -> str:
    """Positives and negatives of a chunk of anchors; where they are stored."""
    column = lambda name: part.column(name).combine_chunks()
    names = pc.unique(column("label"))
    places = pc.index_in(column("label"), names).to_numpy(zero_copy_only=False)
    ids = column("id").to_numpy(zero_copy_only=False)
    own = _Chunk(integers(column("v"), dim, scale), ids, places, column("cell").to_numpy(zero_copy_only=False))
    labels = names.to_pylist()

    def floored(least: np.ndarray, most: np.ndarray, k: int, same: bool) -> DataFrame:
        """The rows each request may keep, those of the thinned rows first."""
        first = _best(walk_all(thinned, own.clusters(least, most, k, same), labels, dim, scale), k)
        floor = least.copy()
        for r in first.where(F.col("rank") == k).select("request", "score").collect():
            at = np.unravel_index(r["request"], floor.shape)
            floor[at] = max(floor[at], r["score"])
        return _best(walk_all(rows, own.clusters(floor, most, k, same), labels, dim, scale), k)

    anywhere = np.full((len(ids), 1), LOW), np.full((len(ids), 1), HIGH)
    best = floored(*anywhere, positives, True).collect()
    least, most = np.full((len(ids), positives), 1), np.zeros((len(ids), positives), dtype=np.int64)  # an empty range: nothing is asked
    positive_ids, positive_scores = np.zeros_like(least), np.zeros_like(least)
    for r in best:
        at, score = (r["request"], r["rank"] - 1), r["score"]
        positive_ids[at], positive_scores[at] = r["id"], score
        least[at], most[at] = -(-low * score // 100), high * score // 100
    wanted = {"anchor_id": np.repeat(ids, positives), "positive_id": positive_ids.ravel(), "positive_score": positive_scores.ravel()}

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            request = batch.column(0).to_numpy(zero_copy_only=False)
            of = {name: pa.array(values[request]) for name, values in wanted.items()}
            yield pa.RecordBatch.from_arrays(
                [of["anchor_id"], of["positive_id"], batch.column(3), batch.column(1), of["positive_score"], batch.column(2)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    kept = floored(least, most, negatives, False).select("request", "id", "score", "rank")
    path = scratch_dir(rows.sparkSession, "hard-negatives")
    kept.mapInArrow(named, SCHEMA).write.parquet(path)
    return path


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    relabelled = vectors.select("vec_id", moved.alias("label"), "embedding")
    return mine_hard_negatives(relabelled, relabelled.where(F.col("vec_id") % 100 == 0))


SQL = """
with v as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select a.r, a.vec_id as anchor_id, v.vec_id, v.label = a.label as same, cast(list_dot_product(a.e, v.e) as bigint) as score
  from v as a join v on a.vec_id <> v.vec_id and len(a.e) = len(v.e) where a.vec_id % 100 = 0
), p as (
  select * from (
    select *, row_number() over (partition by r order by score desc, vec_id) as n from s where same
  ) where n <= 5
), m as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
         cast(row_number() over (partition by p.r, p.n order by s.score desc, s.vec_id) as integer) as rank
  from p join s on s.r = p.r and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from m where rank <= 10
"""
