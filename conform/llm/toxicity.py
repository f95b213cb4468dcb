"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import give_back, read, stored, texts_of, tidied
from conform.llm.quality import held_out

#: Size of the space that words are hashed into.
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7)
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|-"


def words(text: str) -> set[str]:
    """The different words of a text, lower case, without marks around them."""
    return {w for w in (x.strip(_EDGE) for x in set(text.lower().split())) if w}


def keys(word: str) -> list[str]:
    """A word and its beginnings, so that inflected and compound forms share a feature."""
    return [word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


def buckets(text: str) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    found = {k for w in words(text) for k in keys(w)}
    return np.unique(np.array([digest(k) % BUCKETS for k in found], dtype=np.int32))


@dataclass(frozen=True)
class Ensemble:
    """Linear classifiers over the presence of selected buckets; the score is their mean."""

    features: dict[int, int]
    weights: np.ndarray  # members x (features + 1), the last one the offset

    def score(self, text: str, known: dict[str, tuple[int, ...]]) -> float:
        """``known`` remembers the features of a word, up to a bound."""
        import xxhash

        found: set[int] = set()
        for w in words(text):
            of_word = known.get(w)
            if of_word is None:
                if len(known) > 500_000:
                    known.clear()
                hashed = [xxhash.xxh3_64_intdigest(k) % BUCKETS for k in keys(w)]
                of_word = known[w] = tuple(self.features[b] for b in hashed if b in self.features)
            found.update(of_word)
        z = self.weights[:, sorted(found)].sum(axis=1) + self.weights[:, -1]
        return float(np.mean(1 / (1 + np.exp(-np.clip(z, -30, 30)))))


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int,
    epochs: int = 60, batch: int = 512, rate: float = 0.05, decay: float = 1e-4,
) -> np.ndarray:
    """Weights that minimise the non-negative risk with the sigmoid loss.

    risk = prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)). Where the second term of a batch falls
    below zero, the step goes the other way on that term, so that the model cannot earn by
    memorising the positives.
    """
    rng = np.random.default_rng(seed)
    xp = np.hstack([positive, np.ones((len(positive), 1))])
    xu = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])
    w = np.zeros(xp.shape[1])
    w[-1] = -1.0
    m1, m2, t = np.zeros_like(w), np.zeros_like(w), 0
    loss = lambda z: 1 / (1 + np.exp(np.clip(z, -30, 30)))  # noqa: E731  sigmoid loss of margin z
    for _ in range(epochs):
        order = rng.permutation(len(xu))
        for start in range(0, len(xu), batch):
            u = xu[order[start : start + batch]]
            p = xp[rng.integers(0, len(xp), min(batch, len(xp)))]
            zp, zu = p @ w, u @ w
            slope = lambda l: l * (1 - l)
            up = -prior * (p.T @ slope(loss(zp))) / len(p)
            negative = loss(-zu).mean() - prior * loss(-zp).mean()
            down = (u.T @ slope(loss(-zu))) / len(u) - prior * (p.T @ slope(loss(-zp))) / len(p)
            grad = (up + down if negative >= 0 else -down) + decay * w
            t += 1
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
            w = w - rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return w


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_positive: int = 3000, max_unlabelled: int = 6000, max_features: int = 1000, members: int = 3,
) -> Ensemble:
    """An ensemble from confirmed positives and unlabelled text.

    The positives are at most ``max_positive`` documents that ``labels`` marks 1, the unlabelled at most
    ``max_unlabelled`` documents whatever their label, each the first by a hash of the id. The class
    prior is the share of 1 among the labelled rows. Features are the buckets (hashes of words and word beginnings) that are
    over-represented among the positives by more than chance (z over 4), at most ``max_features``, the most so first, counted in
    the tasks; which of these each document of the sample has is all that reaches the driver. Rows with a null
    label or id take no part in learning; an id that any row marks 1 is a positive; rows that repeat an id all count.
    Without a positive or without a feature every text scores alike.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[label_col]: r["count"] for r in marked.groupBy(label_col).count().collect()}
    pick = lambda df, n: [r["id"] for r in df.orderBy(F.xxhash64("id"), "id").limit(n).collect()]
    toxic = pick(marked.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).distinct(), max_positive)
    others = pick(docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct(), max_unlabelled)
    nothing = Ensemble({}, np.full((1, 1), -1.0))
    if not toxic or not others:
        return nothing
    wanted = spark.createDataFrame([(i,) for i in sorted({*toxic, *others})], "id long")
    sample = docs.select(F.col(id_col).cast("long").alias("id"), text_col).join(F.broadcast(wanted), "id", "left_semi")

    positive, other = set(toxic), set(others)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many positives and unlabelled texts of the task have a bucket, beside their numbers (bucket -1)."""
        counts = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                of_text = np.append(buckets(text), BUCKETS)
                for side, ids in enumerate((positive, other)):
                    if i in ids:
                        counts[side, of_text] += 1
        there = np.flatnonzero(counts.any(axis=0))
        names = np.where(there == BUCKETS, -1, there)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts[0, there]), pa.array(counts[1, there])], ["b", "p", "u"])

    counted = sample.mapInArrow(tidied(count), "b long, p long, u long").groupBy("b").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    counted = stored(counted, "toxicity-counts")
    sizes = counted.where("b = -1").first()
    if sizes is None or not sizes["p"] or not sizes["u"]:
        return nothing
    n_p, n_u = sizes["p"], sizes["u"]
    rate_u = (F.col("u") + 0.5) / (n_u + 1)
    z = (F.col("p") / n_p - rate_u) / F.sqrt(rate_u * (1 / n_p + 1 / n_u))
    best = counted.where("b >= 0 and p >= 3").withColumn("z", z).where("z > 4").orderBy(F.desc("z"), "b").limit(max_features)
    chosen = sorted(r["b"] for r in best.collect())
    if not chosen:
        return nothing
    column = {b: i for i, b in enumerate(chosen)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array([column[b] for b in buckets(t).tolist() if b in column], dtype=np.int16).tobytes() for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "at"])

    rows = sorted((r["id"], bytes(r["at"])) for r in sample.mapInArrow(tidied(present), "id long, at binary").collect())

    def matrix(ids: list[int]) -> np.ndarray:
        of: dict[int, list[bytes]] = {}
        for i, at in rows:
            of.setdefault(i, []).append(at)
        mine = [at for i in ids for at in of.get(i, [])]
        out = np.zeros((len(mine), len(chosen)), dtype=np.float32)
        for row, at in zip(out, mine, strict=True):
            row[np.frombuffer(at, dtype=np.int16)] = 1
        return out

    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    xp, xu = matrix(toxic), matrix(others)
    return Ensemble(column, np.stack([fit_nnpu(xp, xu, prior, seed) for seed in range(members)]))


def score_toxicity(docs: DataFrame, model: Ensemble, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text.

    The score sees the text alone. A null text scores as an empty one, which has no words. Rows and
    other columns stay; a column named like ``out_col`` is replaced.
    """

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, tuple[int, ...]] = {}
        for texts in parts:
            yield pa.array([model.score(t, known) for t in texts_of(texts)], pa.float64())
        known.clear()
        give_back()

    return docs.withColumn(out_col, score(F.col(text_col)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    fold = lambda: held_out(parts=5, part=0)
    model = train(docs.where(~fold()), read(spark, sf_dir, "labels").where(~fold()))
    return score_toxicity(docs, model).select(
        "doc_id", fold().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
