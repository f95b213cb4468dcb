"""A table in key-hash buckets, of which an upsert rewrites only those it touches."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.operators.digests import key_bucket
from conform.sources.lake import CommitConflict, Lake


@dataclass(frozen=True)
class BucketedTable:
    """Rows unique per key, in 2 ** ``bits`` folders by the hash of the key.

    A commit is a row that names, for every bucket, the write whose folder holds it. A write makes folders for the
    buckets it touches under a name of its own; the other buckets' files are neither read nor written. A write that
    dies leaves folders that no commit names; of two writes on one state the second is refused and changes nothing.
    Readers see the state before or after. NULL is a key like any other.
    """

    lake: Lake
    path: str
    keys: Sequence[str]
    bits: int = 6

    @property
    def _log(self) -> str:
        return posixpath.join(self.path, "commits")

    def version(self) -> int:
        last = self.lake.last_commit(self._log)
        return last["seq"] if last else 0

    def folders(self, version: int | None = None) -> dict[int, str]:
        """Bucket -> folder of a committed version (default: the newest)."""
        last = self.lake.last_commit(self._log, version)
        parts = [entry.split(":", 1) for entry in last["models"]] if last else []
        return {int(b): posixpath.join(self.path, "data", f"write={w}", f"bucket={b}") for b, w in parts}

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows, with their ``bucket``; of some buckets no other folder is looked at."""
        at = self.folders(version)
        if not at:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        paths = [p for b, p in at.items() if buckets is None or b in set(buckets)]
        base = self.lake.spark.read.option("basePath", posixpath.join(self.path, "data"))
        if paths:
            return base.parquet(*paths).drop("write").withColumn("bucket", F.col("bucket").cast("long"))
        return base.parquet(next(iter(at.values()))).drop("write").withColumn("bucket", F.col("bucket").cast("long")).limit(0)

    def replace(self, df: DataFrame) -> None:
        """Write the whole table."""
        version = self.version()
        write = self._write(self._once_per_key(df), version)
        self._commit(version, {b: write for b in self._written(write)})

    def upsert(self, changes: DataFrame, deleted: DataFrame | None = None) -> list[int]:
        """Put changed and new rows in, take the rows with the keys of ``deleted`` out; returns the touched buckets.

        A key that the changes repeat fails the job before anything is committed. The touched buckets are at most 2 ** ``bits`` numbers.
        """
        version = self.version()
        if not version:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        at = self.folders(version)
        number = key_bucket(self.keys, self.bits)
        keyed = changes.select(*self.keys) if deleted is None else changes.select(*self.keys).unionByName(deleted.select(*self.keys))
        touched = sorted(r["b"] for r in keyed.select(number.alias("b")).distinct().collect())
        if not touched:
            return []
        old = self.read(version, touched).drop("bucket")
        gone = keyed.distinct().select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        fresh = self._once_per_key(changes)
        write = self._write(old.join(gone, same, "left_anti").unionByName(fresh.select(old.columns)), version)
        names = {b: p.split("write=", 1)[1].split("/")[0] for b, p in at.items() if b not in touched}
        self._commit(version, {**names, **{b: write for b in self._written(write)}})
        return touched

    def _once_per_key(self, df: DataFrame) -> DataFrame:
        doubled = F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*self.keys))))
        one = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))
        return one.select(F.when(F.col("_n") == 1, F.col("_row")).otherwise(doubled).alias("_row")).select("_row.*")

    def _write(self, df: DataFrame, version: int) -> str:
        write = self.lake.attempt(version + 1)
        ranged = df.withColumn("bucket", key_bucket(self.keys, self.bits)).repartitionByRange("bucket", F.xxhash64(*self.keys))
        folder = posixpath.join(self.path, "data", f"write={write}")
        ranged.sortWithinPartitions("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
        return write

    def _written(self, write: str) -> list[int]:
        names = self.lake.folders_of(posixpath.join(self.path, "data", f"write={write}"))
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("bucket="))

    def _commit(self, version: int, buckets: dict[int, str]) -> None:
        if not self.lake.try_commit(self._log, version, "write", [f"{b}:{w}" for b, w in sorted(buckets.items())]):
            raise CommitConflict(f"{self.path} has moved on from version {version}; read it again and repeat the change")
