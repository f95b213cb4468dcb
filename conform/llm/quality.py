"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import give_back, read, texts_of, tidied

# Character classes: lower, upper, digit, space, sentence mark, bracket or quote, other mark.
_CLASSES = 7
_TABLE = np.zeros(0x250, dtype=np.uint8)
for _code in range(0x250):
    _c = chr(_code)
    _TABLE[_code] = (
        1 if _c.isupper() else 0 if _c.isalpha() else 2 if _c.isdigit() else 3 if _c.isspace() else
        4 if _c in ".,;:?" else 5 if _c in "\"'()-" else 6
    )
_EDGES = (0.02, 0.1, 0.25, 0.5)
_RAW = 8
#: Features of one line, without its neighbours: constant, raw values, values over edges.
OWN = 1 + _RAW + _RAW * len(_EDGES)
WIDTH = 3 * OWN


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line (own, previous, next) and the lines' lengths; an empty text is one empty line."""
    lines = text.split("\n")
    n = len(lines)
    lengths = np.array([len(line) for line in lines], dtype=np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _TABLE[np.minimum(codes, 0x24F)]  # what lies beyond counts as a letter
    line_of = np.repeat(np.arange(n), lengths + 1)[: len(codes)]
    counts = np.bincount(line_of * _CLASSES + kinds, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    counts[: n - 1, 3] -= 1  # line ends
    letters = counts[:, 0] + counts[:, 1]
    size = np.maximum(lengths, 1)
    seen: dict[str, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    raw = np.empty((n, _RAW))
    raw[:, 0] = counts[:, 1] / np.maximum(letters, 1)
    raw[:, 1] = counts[:, 2] / size
    raw[:, 2] = counts[:, 6] / size * 4
    raw[:, 3] = counts[:, 4] / size * 4
    raw[:, 4] = 1 - letters / size
    for i, line in enumerate(lines):
        words = line.split()
        raw[i, 5] = 1 - len(set(words)) / len(words) if words else 0.0
        raw[i, 6] = min(1.0, letters[i] / (20.0 * len(words))) if words else 0.0
        raw[i, 7] = seen[line] > 1 and len(line) > 0
    np.clip(raw, 0, 1, out=raw)
    own = np.hstack([np.ones((n, 1)), raw, *[raw > e for e in _EDGES]])
    out = np.zeros((n, WIDTH), dtype=np.float32)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN :] = own[1:]
    return out, lengths


@dataclass(frozen=True)
class Chain:
    """Weights of the state "good" against "bad", and scores of moving between states (bad 0, good 1)."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, features: np.ndarray) -> list[float]:
        """P(good) of each line by forward and backward passes, in odds of good against bad."""
        unary = np.clip(features @ self.weights, -40, 40)
        a, b, c, d = (math.exp(x) for x in self.moves.ravel())
        gain = np.exp(unary).tolist()
        ahead, back = [0.0] * len(gain), [0.0] * len(gain)
        odds = gain[0]
        ahead[0] = odds
        for t in range(1, len(gain)):
            odds = gain[t] * (b + odds * d) / (a + odds * c)
            odds = min(max(odds, 1e-200), 1e200)
            ahead[t] = odds
        odds = 1.0
        back[-1] = odds
        for t in range(len(gain) - 2, -1, -1):
            following = gain[t + 1] * odds
            odds = (c + d * following) / (a + b * following)
            back[t] = odds
        out = []
        for x, y in zip(ahead, back, strict=True):
            z = min(x * y, 1e200)
            out.append(z / (1 + z))
        return out

    def score(self, text: str) -> float:
        """Length-weighted mean of the lines' P(good)."""
        features, lengths = line_features(text)
        weight = np.maximum(lengths, 1)
        return float(np.dot(self.marginals(features), weight) / weight.sum())


def fit_chain(docs: list[np.ndarray], good: list[int], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Chain:
    """Maximum likelihood with every line of a document carrying the document's label.

    All chains advance one line at a time together; chains are sorted by length so that each step works on
    those that are still running. Each class has half of the total weight.
    """
    weights, moves = np.zeros(WIDTH), np.zeros((2, 2))
    classes = set(good)
    if len(classes) < 2:  # nothing to tell apart
        weights[0] = 0.0 if not classes else 3.0 if classes == {1} else -3.0
        return Chain(weights, moves)
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    y = np.array([good[i] for i in order])
    sizes = np.array([len(docs[i]) for i in order])
    steps = sizes.max()
    alive = [int((sizes > t).sum()) for t in range(steps)]
    x = np.concatenate([np.stack([docs[order[i]][t] for i in range(alive[t])]) for t in range(steps)]).astype(np.float64)
    at = np.concatenate([[0], np.cumsum(alive)])
    label = np.concatenate([y[: alive[t]] for t in range(steps)])
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) / np.maximum(1, sizes) ** 0.5
    line_share = np.concatenate([share[: alive[t]] for t in range(steps)])
    total = line_share.sum()
    m1, m2 = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for r in range(1, rounds + 1):
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ weights
        fwd, bwd = np.empty_like(unary), np.zeros_like(unary)
        fwd[: at[1]] = unary[: at[1]]
        for t in range(1, steps):
            before = fwd[at[t - 1] : at[t - 1] + alive[t]]
            fwd[at[t] : at[t + 1]] = unary[at[t] : at[t + 1]] + np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1])
        for t in range(steps - 2, -1, -1):
            after = unary[at[t + 1] : at[t + 2]] + bwd[at[t + 1] : at[t + 2]]
            bwd[at[t] : at[t] + alive[t + 1]] = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
        both = fwd + bwd
        norm = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - norm)
        slope = (label - p) * line_share
        grad_w = x.T @ slope / total - decay * weights
        grad_m = np.zeros((2, 2))
        for t in range(1, steps):
            n = alive[t]
            before, now = slice(at[t - 1], at[t - 1] + n), slice(at[t], at[t + 1])
            after = unary[now] + bwd[now]
            joint = np.exp(fwd[before][:, :, None] + moves + after[:, None, :] - norm[now][:, None, None])
            grad_m -= np.einsum("i,ijk->jk", line_share[now], joint)
            for s in (0, 1):
                grad_m[s, s] += line_share[now][label[now] == s].sum()
        grad = np.concatenate([grad_w, (grad_m / total - decay * moves).ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        step = rate * (m1 / (1 - 0.9**r)) / (np.sqrt(m2 / (1 - 0.99**r)) + 1e-8)
        weights, moves = weights + step[:WIDTH], moves + step[WIDTH:].reshape(2, 2)
    return Chain(weights, moves)


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    per_class: int = 1500, max_lines: int = 60_000,
) -> Chain:
    """A chain fitted on a bounded sample: at most ``per_class`` labelled documents a class, the first by
    a hash of the id, while they have ``max_lines`` lines together, by id. Lines are counted first, and only the features of what
    fits reach the driver. Null ids and null labels take no part, nor does an id with both labels; rows that repeat an
    id all count, a null text as an empty one. Without a label of each class nothing is told apart."""
    ids: dict[int, int] = {}
    for value in (0, 1):
        of_class = labels.where(F.col(label_col) == value).select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
        for r in of_class.orderBy(F.xxhash64("id"), "id").limit(per_class).collect():
            ids[r["id"]] = value if r["id"] not in ids else -1
    wanted = {i: value for i, value in ids.items() if value >= 0}
    if not wanted:
        return fit_chain([], [])
    lines = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    picked = docs.where(F.col(id_col).isin(list(wanted))).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), lines.alias("n"))
    kept, left = [], max_lines
    for r in picked.groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect():  # two numbers a picked document
        if r["n"] <= left:
            left -= r["n"]
            kept.append(r["id"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(t)[0].tobytes() for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "features"])

    rows = picked.where(F.col("id").isin(kept)).select("id", "text").mapInArrow(tidied(features), "id long, features binary").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["features"])))
    x = [np.frombuffer(row["features"], dtype=np.float32).reshape(-1, WIDTH) for row in rows]
    return fit_chain(x, [wanted[row["id"]] for row in rows])


def score_quality(docs: DataFrame, chain: Chain, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; see :meth:`Chain.score`.

    The score sees the text alone. A null text scores as an empty one. Rows and other columns stay
    as they are; a column that is named like ``out_col`` is replaced.
    """

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([chain.score(t) for t in texts_of(texts)], pa.float64())
        give_back()

    return docs.withColumn(out_col, score(F.col(text_col)))


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def fitted(spark: SparkSession, sf_dir: str) -> Chain:
    """The chain of the rows that may be learned from."""
    return train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where(~held_out()))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, fitted(spark, sf_dir)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
