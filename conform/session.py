"""Session settings and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for right results or for skewed inputs.
# Nothing here is sized to a machine; cluster sizing belongs to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Plans are built by code; without call sites per expression they build faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "conform", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, unique per call.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, so
    a lost executor loses nothing. A session without that setting gets a local folder if it runs
    on one machine, and an error otherwise.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.conf.get("spark.master", None) or "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return posixpath.join(base, f"{purpose}-{uuid.uuid4().hex}")


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="conform-")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate: file size for a stored table, mostly an upper bound otherwise."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcastable(df: DataFrame) -> bool:
    """Whether the size estimate lets Spark broadcast the frame.

    A small result derived from large inputs says no; see :func:`sized`.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back; its lineage ends there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, purpose: str) -> DataFrame:
    """The frame with a size Spark can trust.

    Where the estimate alone rules a broadcast out, the frame is written to the shared
    scratch folder and read back, so its real size decides. Without that, Spark would
    shuffle the large side first and find out afterwards that it need not have. Meant
    for tables that are small next to what they are joined to.
    """
    if broadcastable(df):
        return df
    return stored(df, purpose)
