"""The lake: paths of the four tiers, idempotent writes, snapshots, publish and roll back.

Plain Parquet has no transactions, so every switch of state is one small file in a
commit log, written last and created only if it is not there. A data folder is written once and never changed after its
commit; readers follow the log, so they see the state before or after, never between.
A job that dies half-way leaves a folder that no commit names. Of two writers that start from
the same state one commits; the other finds the number taken and is refused, or tries again
where its change does not depend on the state (see :meth:`Lake.publish`).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.operators import curve, history
from conform.operators.history import FROM, TO

DATE = "load_date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder for a NULL
COMMIT = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ref", T.StringType()),
        T.StructField("models", T.ArrayType(T.StringType())),
    ]
)


#: Rows of a file, where the number of files follows the table: a task sorts that many, however large the table.
FILE_ROWS = 500_000


def file_count(df: DataFrame, least: int = 1, rows: int = FILE_ROWS) -> int:
    """Into how many files to write a stored table so that none has much more than ``rows`` rows: ``least`` or more.

    An action that counts the rows; Parquet files answer it from their footers.
    """
    return max(least, -(-df.count() // rows))


class PublishError(RuntimeError):
    """A model of the run is missing or empty; nothing was published."""


class CommitConflict(RuntimeError):
    """Another writer has committed since the state was read; nothing was changed."""


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    # --- paths --------------------------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def bronze(self, source: str, table: str) -> str:
        return self._path("bronze", source, table)

    def silver(self, model: str) -> str:
        return self._path("silver", model)

    def gold(self, run_id: str, model: str) -> str:
        return self._path("gold", run_id, model)

    def snapshot(self, name: str) -> str:
        return self._path("snapshots", name)

    def quality(self) -> str:
        return self._path("quality", "results")

    def exceptions(self, run_id: str) -> str:
        return self._path("quality", "exceptions", run_id)

    # --- dated tables -------------------------------------------------------------------

    def write_date(self, df: DataFrame, path: str, load_date: str | dt.date) -> None:
        """Replace one date of a table and leave the others alone; a rerun gives the same rows.

        The date's own folder is written, so a frame without rows empties the date.
        """
        folder = posixpath.join(path, f"{DATE}={dt.date.fromisoformat(str(load_date))}")
        df.drop(DATE).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)

    def write_dates(self, df: DataFrame, path: str, day: str | Column) -> None:
        """Replace every date that occurs in the frame, each row under its own date.

        Rows without a date go to a folder of their own; :meth:`read_undated` gives them.

        Rows are ranged by date and content first: a date gets a few whole files, and a
        date holding much of the table is shared by many tasks.
        """
        dated = df.withColumn(DATE, (F.col(day) if isinstance(day, str) else day).cast("date"))
        ranged = dated.repartitionByRange(DATE, F.xxhash64(*df.columns))
        (
            ranged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DATE)
            .parquet(path)
        )

    def read_date(self, path: str, load_date: str | dt.date) -> DataFrame:
        """Exactly the date asked for, which must be there: an older one is never served instead."""
        if str(load_date) not in self.dates(path):
            raise FileNotFoundError(f"{path} has no {DATE}={load_date}")
        return self.spark.read.parquet(path).where(F.col(DATE) == F.lit(str(load_date)).cast("date"))

    def read_latest(self, path: str) -> DataFrame:
        dates = self.dates(path)
        if not dates:
            raise FileNotFoundError(f"{path} has no {DATE}")
        return self.read_date(path, dates[-1])

    def read_undated(self, path: str) -> DataFrame:
        """The rows of a table that have no date."""
        return self.spark.read.parquet(path).where(F.col(DATE).isNull())

    def dates(self, path: str) -> list[str]:
        """Dates of a table from its folder names; no file is opened. Rows without a date have none."""
        values = [n.split("=", 1)[1] for n in self._children(path) if n.startswith(f"{DATE}=")]
        return sorted(v for v in values if v != NO_DATE)

    def _children(self, path: str) -> list[str]:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return []
        return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]

    def exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    # --- models -------------------------------------------------------------------------

    def write_model(self, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
        """Write one model in full and give back the stored copy, so later stages start from it."""
        self._refuse_published(path)
        df.write.mode("overwrite").format(fmt).save(path)
        return self.spark.read.format(fmt).schema(df.schema).load(path)

    def write_clustered(
        self,
        df: DataFrame,
        path: str,
        cluster: Sequence[str],
        tiebreak: Sequence[str] | None = None,
        partitions: Sequence[str] = (),
        files: int | None = None,
        fmt: str = "parquet",
    ) -> DataFrame:
        """Write sorted by the cluster columns, so that a filter on them skips most row groups.

        Ranges are cut on the cluster columns *and* a tiebreak (by default a hash of the
        row): a value holding a third of the rows is shared by many tasks and still lies
        together. ``partitions`` become folders. ``files`` fixes the number of tasks, each of which sorts its
        share: take :func:`file_count` for a table that grows.
        """
        self._refuse_published(path)
        spread = [F.col(c) for c in tiebreak] if tiebreak else [F.xxhash64(*df.columns)]
        by = [F.col(c) for c in dict.fromkeys([*partitions, *cluster])] + spread
        ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
        ordered = ranged.sortWithinPartitions(*partitions, *cluster)
        full = ordered.write.mode("overwrite").option("partitionOverwriteMode", "static")
        full.format(fmt).partitionBy(*partitions).save(path)
        return self.spark.read.format(fmt).schema(df.schema).load(path)

    def write_on_curve(
        self, df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = curve.BITS, fmt: str = "parquet"
    ) -> DataFrame:
        """Write clustered on several columns alike, so that a filter on any of them skips most files.

        Files are ranges of the curve through the columns' quantile ranks and of a row hash: a combination of values that
        holds much of the table is shared by many tasks. ``files`` as for :meth:`write_clustered`.
        """
        self._refuse_published(path)
        place = next(n for n in (f"place{'_' * i}" for i in range(len(df.columns) + 1)) if n not in df.columns)
        placed = curve.with_place(df, columns, place, bits)
        by = [F.col(place), F.xxhash64(*df.columns)]
        ranged = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
        ranged.sortWithinPartitions(place, *columns).drop(place).write.mode("overwrite").format(fmt).save(path)
        return self.spark.read.format(fmt).schema(df.schema).load(path)

    def written_rows(self, path: str, fmt: str = "parquet") -> int:
        """Rows that can be read back; no column is read."""
        return self.spark.read.format(fmt).load(path).count()

    def append_quality(self, results: DataFrame, run_id: str, model: str) -> None:
        """Keep check results under their run and model; a rerun replaces its own."""
        (
            results.withColumns({"run_id": F.lit(run_id), "model": F.lit(model)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "model")
            .parquet(self.quality())
        )

    def read_quality(self, run_id: str) -> DataFrame:
        return self.spark.read.parquet(posixpath.join(self.quality(), f"run_id={run_id}"))

    # --- commit log ---------------------------------------------------------------------

    def folders_of(self, path: str) -> list[str]:
        return self._children(path)

    def attempt(self, seq: int) -> str:
        """A name for one writer's try at a version; no other try has it."""
        return f"{seq}-{uuid.uuid4().hex[:12]}"

    def _create(self, path: str, text: str) -> bool:
        """Create a file with its content unless it is there, in one step that only one writer can take."""
        from py4j.protocol import Py4JJavaError

        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(target.getParent())
        try:
            if fs.getScheme() == "file":  # here create() looks first and creates then; a link does both at once
                whole = fs.makeQualified(target).toUri().getPath()
                draft = posixpath.join(posixpath.dirname(whole), f".{uuid.uuid4().hex}")
                with open(draft, "x") as out:
                    out.write(text)
                try:
                    os.link(draft, whole)
                finally:
                    os.unlink(draft)
            else:
                out = fs.create(target, False)
                out.write(bytearray(text.encode()))
                out.close()
        except FileExistsError:
            return False
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def _commits(self, log: str) -> dict[int, str]:
        """Number -> file of what was committed, and of files left empty by a writer that died."""
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(log)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return {}
        files = {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(target) if s.isFile()}
        return {int(n.removesuffix(".json")): p for n, p in files.items() if n.removesuffix(".json").isdigit()}

    def try_commit(self, log: str, after: int, ref: str, models: Sequence[str]) -> int | None:
        """Commit as the next number after ``after`` if nothing has been committed since; the number, or None."""
        later = {n: p for n, p in self._commits(log).items() if n > after}
        if any(self._read_commits([p]) for p in later.values()):
            return None
        seq = max([after, *later]) + 1
        row = json.dumps({"seq": seq, "ref": ref, "models": list(models)})
        return seq if self._create(posixpath.join(log, f"{seq:020d}.json"), row + "\n") else None

    def _read_commits(self, files: Sequence[str]) -> list:
        return self.spark.read.schema(COMMIT).json(list(files)).orderBy("seq").collect() if files else []

    def last_commit(self, log: str, upto: int | None = None):
        """The newest commit, or the newest up to a number; one file is read."""
        for _, path in sorted(self._commits(log).items(), reverse=True):
            rows = self._read_commits([path])
            if rows and (upto is None or rows[0]["seq"] <= upto):
                return rows[0]
        return None

    def all_commits(self, log: str) -> list:
        """All commits in order; a log holds one small row per run."""
        return self._read_commits(list(self._commits(log).values()))

    # --- snapshots ----------------------------------------------------------------------

    def _snapshot_log(self, name: str) -> str:
        return posixpath.join(self.snapshot(name), "commits")

    def snapshot_version(self, name: str) -> int:
        last = self.last_commit(self._snapshot_log(name))
        return last["seq"] if last else 0

    def _snapshot_folders(self, name: str, version: int) -> list[int]:
        """Numbers of the data folders that make up a version, the one of its open rows last."""
        return [int(r["models"][1]) for r in self.all_commits(self._snapshot_log(name)) if r["seq"] <= version]

    def read_snapshot(self, name: str, version: int | None = None) -> DataFrame | None:
        """History as of a committed version (default: the newest), or None before the first run."""
        v = self.snapshot_version(name) if version is None else version
        if v == 0:
            return None
        parts = self._snapshot_folders(name, v)
        stored = self.spark.read.parquet(posixpath.join(self.snapshot(name), "data"))
        is_open, at = F.col("is_open") == 1, F.col("version")
        return stored.where((is_open & (at == parts[-1])) | (~is_open & at.isin(parts))).drop("is_open", "version")

    def update_snapshot(
        self,
        name: str,
        feed: DataFrame,
        keys: Sequence[str],
        check_cols: Sequence[str],
        snapshot_ts: str | dt.datetime,
        close_missing: bool = False,
    ) -> DataFrame:
        """Merge a feed into a stored history and commit; gives back the history.

        Versions are folders: each holds all open rows and only the rows it closed. So a
        run reads and writes the open rows, while the closed past is never read or
        written again. A folder belongs to one writer; if another has committed a feed in the meantime, this one
        raises :class:`CommitConflict` and the history is as the other left it.
        """
        v = self.snapshot_version(name)
        if v == 0:
            merged = history.first_snapshot(feed, snapshot_ts)
        else:
            stored = self.spark.read.parquet(posixpath.join(self.snapshot(name), "data"))
            open_rows = stored.where((F.col("is_open") == 1) & (F.col("version") == self._snapshot_folders(name, v)[-1]))
            merged = history.merge_open(
                open_rows.drop("is_open", "version"), feed, keys, check_cols, snapshot_ts, close_missing
            )
        folder = self._claim(posixpath.join(self.snapshot(name), "claims"), v + 1)
        (
            merged.withColumn("is_open", F.col(TO).isNull().cast("int"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("is_open")
            .parquet(posixpath.join(self.snapshot(name), "data", f"version={folder}"))
        )
        done = self.try_commit(self._snapshot_log(name), v, str(snapshot_ts), [name, str(folder)])
        if done is None:
            raise CommitConflict(f"snapshot {name} has moved on from version {v}; merge the feed again")
        return self.read_snapshot(name, done)

    def _claim(self, path: str, least: int) -> int:
        """The first number from ``least`` on that no other writer has claimed."""
        while not self._create(posixpath.join(path, f"{least:020d}"), "claimed\n"):
            least += 1
        return least

    # --- publish ------------------------------------------------------------------------

    def verify(self, run_id: str, models: Sequence[str]) -> dict[str, int]:
        """Rows per model of a run; raises when a model is missing or empty."""
        counts = {}
        for model in models:
            path = self.gold(run_id, model)
            if not self.exists(path):
                raise PublishError(f"{model} is missing from run {run_id}")
            counts[model] = self.written_rows(path)
            if counts[model] == 0:
                raise PublishError(f"{model} of run {run_id} is empty")
        return counts

    def publish(self, run_id: str, models: Sequence[str], expected: str | None = None) -> dict[str, int]:
        """Make a run current, all models at once. Publishing an older run rolls back.

        Writers may publish at the same time: each takes the next free number of the log, and the last one is current, so no commit
        is lost. With ``expected`` the publish stands only if that run is current when it is committed, and is refused with
        :class:`CommitConflict` otherwise.
        """
        counts = self.verify(run_id, models)
        log = self._path("gold_commits")
        while True:
            last = self.last_commit(log)
            current = last["ref"] if last else None
            if expected is not None and current != expected:
                raise CommitConflict(f"{current} is current, not {expected}; {run_id} was not published")
            if self.try_commit(log, last["seq"] if last else 0, run_id, models) is not None:
                return counts

    def published(self, run_id: str) -> bool:
        """Whether a run has ever been current."""
        return any(r["ref"] == run_id for r in self.all_commits(self._path("gold_commits")))

    def _refuse_published(self, path: str) -> None:
        gold = self._path("gold") + "/"
        if path.startswith(gold) and self.published(path[len(gold) :].split("/")[0]):
            raise PublishError(f"{path} belongs to a run that was published; build under a new run id")

    def current_run(self) -> str | None:
        last = self.last_commit(self._path("gold_commits"))
        return last["ref"] if last else None

    def read_current(self, model: str) -> DataFrame:
        run_id = self.current_run()
        if run_id is None:
            raise FileNotFoundError("nothing has been published")
        return self.spark.read.parquet(self.gold(run_id, model))

    def register_current(self, prefix: str = "", tables: bool = False) -> list[str]:
        """Expose the published models by name: temp views, or read-only external tables.

        Call again after a publish to point the names at the new run.
        """
        last = self.last_commit(self._path("gold_commits"))
        names = []
        for model in last["models"] if last else []:
            path, name = self.gold(last["ref"], model), prefix + model
            if tables:
                self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
                self.spark.catalog.createTable(name, path=path, source="parquet")
            else:
                self.spark.read.parquet(path).createOrReplaceTempView(name)
            names.append(name)
        return names

def snapshot_schema(feed: T.StructType) -> T.StructType:
    """Schema of a history kept for a feed."""
    return T.StructType(
        [*feed.fields, T.StructField(FROM, T.TimestampType()), T.StructField(TO, T.TimestampType())]
    )
