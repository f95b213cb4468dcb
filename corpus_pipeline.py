"""The training-data pipeline: five stages from ``documents`` to token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. All but the last return the
columns of ``documents``. A stage lowers the session's ``maxBytesPerBatch`` for Arrow, as its frame is planned after it returns; :func:`run`
puts the setting back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm import near_dup, pieces, quality, secrets, tiling
from conform.llm.common import bitmap, flagged, fresh, read, stored, without

#: A document goes if its quality score is below this.
KEEP_FROM = 0.5

#: Text of one block of the encoder: half of its own default, as executors still hold memory of the stages before.
BLOCK_BYTES = 2 << 20

#: Bytes of the rows that go to a Python worker at a time. Spark bounds their number only, and 10,000 texts are held in the JVM and in the worker at once.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. A null text scores as an empty one; each row is judged by itself."""
    score = fresh(docs, stem="score")
    scored = quality.score_quality(docs, quality.fitted(spark, sf_dir), out_col=score)
    return scored.where(F.col(score) >= KEEP_FROM).select(docs.columns)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document, the one with the smallest id; documents without words link with nothing and stay.

    Rows that repeat an id, and rows with a null id, are documents of their own, told apart by their text: each stays unless it is a near duplicate
    of one that stays. They come after all others in the choice. Of rows that are equal in id and text, or that differ in
    other columns only, one stays, the first by those columns.
    """
    key, n = fresh(docs, stem="key"), fresh(docs, stem="n")
    several = stored(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"), "pipeline-several")
    own = (F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").bitwiseAND(F.lit((1 << 62) - 1)) + (1 << 62)).alias(key)
    if several.isEmpty():
        keyed = docs.withColumn(key, F.col("doc_id"))
    else:
        maybe = F.col("doc_id").isNull() | flagged(bitmap(several, "doc_id"), "doc_id")
        there = several.where("doc_id is not null").withColumn(n, F.lit(1))
        doubtful = docs.where(maybe).join(there, "doc_id", "left").withColumn(key, F.when(F.col("doc_id").isNotNull() & F.col(n).isNull(), F.col("doc_id")).otherwise(own)).drop(n)
        doubtful = doubtful.select(*docs.columns, key)
        first = Window.partitionBy(key).orderBy(*[F.col(c) for c in docs.columns])
        doubtful = doubtful.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).drop(n)
        keyed = docs.where(~maybe).withColumn(key, F.col("doc_id")).unionByName(stored(doubtful, "pipeline-doubtful"))
    classes = near_dup.near_duplicates(keyed.select(key, "text"), id_col=key)
    return without(keyed, classes.where(F.col(key) != F.col("component_id")), key).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without tiled benchmark items. Each row is judged by its own text, also where rows have one id or none."""
    found = stored(tiling.contaminated(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "text_sha").distinct(), "pipeline-leaks")
    sha = fresh(docs, stem="sha")
    maybe = F.col("doc_id").isNull() | flagged(bitmap(found, "doc_id"), "doc_id")
    judged = docs.where(maybe).withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("d")
    same = (F.col(f"d.{sha}") == F.col("f.text_sha")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
    return docs.where(~maybe).unionByName(judged.join(found.alias("f"), same, "left_anti").select(docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets of one source masked however many of its documents hold them; ``n_chars`` follows the text, null for a null one."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and whether the ids decode to the text, for every row; a null text is an empty one."""
    import public_tokenizers

    return pieces.encoded_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), BLOCK_BYTES)


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with its texts passed to Python workers in batches of bounded bytes. The rows are the same."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)

    return bounded


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", in_small_batches(keep_good)),
    ("n-gram Jaccard join", in_small_batches(keep_one_per_group)),
    ("benchmark decontamination", in_small_batches(drop_benchmark)),
    ("secret scans", in_small_batches(mask_secrets)),
    ("SentencePiece encoding and decoding", in_small_batches(encode)),
]
#: SQL cannot say what the classifier and the encoder do; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read again."""
    docs, before = read(spark, sf_dir, "documents"), spark.conf.get(BATCH, None)
    try:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)
    return docs
