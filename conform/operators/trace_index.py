"""Tracing rows back through stored layers by an index from key to file.

A stored layer keeps, beside its data, one row per trace key and file. A hop asks the index which files
hold the keys that it looks for and opens no other; a layer laid out by its key has few of them.
"""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators.joins import needs_salt, salted_join, same_types
from conform.session import stored

TASK_ROWS = 250_000  # that a task of the index's build groups and sorts
FOLDERS = 256  # of an index, by the first bits of the hash; a lookup of few keys opens few of them


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _folder(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 56).cast("int")


@dataclass(frozen=True)
class IndexedLayer:
    """A stored layer on the way back: see :class:`~conform.operators.reconcile.Layer` for the last three."""

    name: str
    path: str
    key: Column
    upper_key: str
    keep: Sequence[str]

    @property
    def index(self) -> str:
        return posixpath.normpath(self.path) + "_trace"


def write_index(spark: SparkSession, layer: IndexedLayer) -> None:
    """Index a stored layer: one pass over the key's columns, one row per key and file.

    Build it after the layer is written. The tasks grow in number with the layer's rows and not in size. Rows are dealt by key *and* file, so
    a key with a third of the rows sends no task more than a file's rows of it; an index row is ranged by its hash, so such a key then costs a row a file.
    """
    whole = spark.read.parquet(layer.path)
    tasks = max(1, -(-whole.count() // TASK_ROWS))  # from the files' footers
    known = whole.where(layer.key.isNotNull())
    # Grouped behind the shuffle: before it, a task would hold all keys of its share of the files, which grows with them.
    rows = known.select(_hash(layer.key).alias("h"), F.col("_metadata.file_path").alias("file")).repartition(tasks, "h", "file")
    once = rows.groupBy("h", "file").agg(F.count(F.lit(1)).alias("rows"))
    ranged = once.withColumn("folder", _folder(F.col("h"))).repartitionByRange(tasks, "folder", "h")
    ranged.sortWithinPartitions("folder", "h").write.mode("overwrite").partitionBy("folder").parquet(layer.index)


def files_of(spark: SparkSession, layer: IndexedLayer, asked: DataFrame) -> list[str]:
    """The files of a layer that hold any of the asked keys (column ``h``): names only, as the scan of the layer lists them too."""
    folders = [r["f"] for r in asked.select(_folder(F.col("h")).alias("f")).distinct().collect()]  # FOLDERS at most
    index = spark.read.schema("h long, file string, rows long, folder int").parquet(layer.index)
    found = index.where(F.col("folder").isin(folders)).join(asked, "h", "left_semi").select("file").distinct()
    return sorted(r["file"] for r in found.collect())


def trace_indexed(rows: DataFrame, layers: Sequence[IndexedLayer]) -> DataFrame:
    """What :func:`~conform.operators.reconcile.trace_back` gives over the same layers, from the files that the index names.

    A row whose source is gone shows NULLs. The start rows, the asked keys and each hop's result are stored. An index hash that two keys share
    opens a file too many and joins nothing. A layer written anew must be indexed anew.
    """
    spark, out = rows.sparkSession, stored(rows, "trace")
    for layer in layers:
        keyed = out.withColumn("_trace", F.col(layer.upper_key))
        whole = spark.read.parquet(layer.path)
        same_types(keyed, whole.select(layer.key.alias("_trace")), {"_trace": "_trace"})
        asked = stored(keyed.where("_trace is not null").select("_trace").distinct().withColumn("h", _hash(F.col("_trace"))), "trace-keys")
        files = files_of(spark, layer, asked.select("h"))
        held = spark.read.schema(whole.schema).option("basePath", layer.path).parquet(*files) if files else whole.limit(0)
        lower = held.select(layer.key.alias("_trace"), *layer.keep)
        found = stored(lower.join(asked.select("_trace"), "_trace", "left_semi"), "trace-found")
        joined = salted_join(keyed, found, ["_trace"]) if needs_salt(keyed, found) else keyed.join(found, "_trace", "left")
        out = stored(joined.drop("_trace"), "trace")
    return out
