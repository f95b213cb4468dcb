"""Data-quality checks: one row per check, all row-level checks of a table in one aggregate.

A result row is ``check, severity, failing, total, observed, passed``. Failing rows are
counted, never collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.functions.keys import as_column
from conform.operators.joins import orphan_keys

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """One check. ``where`` limits it to some rows; ``severity`` decides whether it blocks."""

    kind: str
    column: str | None = None
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None
    where: str | None = None
    severity: str = ERROR
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or "_".join(p for p in (self.kind, self.column) if p)


def not_null(column: str, **kw: Any) -> Check:
    return Check("not_null", column, **kw)


def unique(column: str, **kw: Any) -> Check:
    """NULL is not compared."""
    return Check("unique", column, **kw)


def accepted_values(column: str, values: Sequence, **kw: Any) -> Check:
    """NULL passes."""
    return Check("accepted_values", column, values=tuple(values), **kw)


def accepted_range(
    column: str, low: float | None = None, high: float | None = None, **kw: Any
) -> Check:
    """Both bounds inclusive; NULL passes."""
    return Check("accepted_range", column, low=low, high=high, **kw)


def relationships(column: str, parent: DataFrame, parent_column: str, **kw: Any) -> Check:
    """Every non-NULL value exists in the parent."""
    return Check("relationships", column, parent=parent, parent_column=parent_column, **kw)


def row_count(low: float | None = None, high: float | None = None, **kw: Any) -> Check:
    """Rows between two bounds; equal bounds ask for an exact count, ``low=1`` for not empty."""
    return Check("row_count", low=low, high=high, **kw)


def proportion_not_null(
    column: str, low: float | None = None, high: float | None = None, **kw: Any
) -> Check:
    return Check("proportion_not_null", column, low=low, high=high, **kw)


def distinct_in_set(column: str, values: Sequence, **kw: Any) -> Check:
    """Counts distinct values outside the set; NULL is ignored."""
    return Check("distinct_in_set", column, values=tuple(values), **kw)


def _outside(c: Column, low: float | None, high: float | None) -> Column:
    out = F.lit(False)
    if low is not None:
        out = out | (c < low)
    if high is not None:
        out = out | (c > high)
    return out


def _in_scope(check: Check) -> Column:
    return F.coalesce(F.expr(check.where), F.lit(False)) if check.where else F.lit(True)


def _row_level(check: Check) -> tuple[Column, Column, Column]:
    """Aggregates for (failing, total, observed)."""
    scope = _in_scope(check)
    total = F.count_if(scope)
    c = as_column(check.column) if check.column else None
    bad = {
        "not_null": lambda: c.isNull(),
        "accepted_values": lambda: ~c.isin(*check.values),
        "accepted_range": lambda: _outside(c, check.low, check.high),
    }.get(check.kind)
    if bad:
        failing = F.count_if(scope & F.coalesce(bad(), F.lit(False)))
        return failing, total, failing.cast("double")
    if check.kind == "row_count":
        observed = total.cast("double")
    elif check.kind == "proportion_not_null":
        # An empty table has no proportion; it fails.
        observed = F.count_if(scope & c.isNotNull()) / F.nullif(total, F.lit(0))
    else:
        raise ValueError(f"unknown check {check.kind!r}")
    miss = F.coalesce(_outside(observed, check.low, check.high), F.lit(True))
    return miss.cast("bigint"), total, observed


def _result(check: Check, failing: Column, total: Column, observed: Column) -> Column:
    return F.struct(
        F.lit(check.label).alias("check"),
        F.lit(check.severity).alias("severity"),
        failing.cast("bigint").alias("failing"),
        total.cast("bigint").alias("total"),
        observed.cast("double").alias("observed"),
        (failing == 0).alias("passed"),
    )


def _one_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    aggs, rows = [], []
    for i, check in enumerate(checks):
        for part, agg in zip("fto", _row_level(check)):
            aggs.append(agg.alias(f"{part}{i}"))
        rows.append(_result(check, F.col(f"f{i}"), F.col(f"t{i}"), F.col(f"o{i}")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _one(check: Check, counted: DataFrame) -> DataFrame:
    failing = F.coalesce("failing", F.lit(0))
    total = F.coalesce("total", F.lit(0))
    return counted.select(F.inline(F.array(_result(check, failing, total, failing))))


def _grouped(df: DataFrame, check: Check) -> DataFrame:
    """Checks over values: counted per value first, so a hot value costs one row per task."""
    scoped = df.where(_in_scope(check))
    c = F.col(check.column)
    per_value = scoped.groupBy(c.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").alias("total")
    seen = F.col("_v").isNotNull()
    if check.kind == "unique":
        bad = F.count_if(seen & (F.col("_n") > 1))
    elif check.kind == "distinct_in_set":
        bad = F.count_if(seen & ~F.col("_v").isin(*check.values))
    else:
        orphans = orphan_keys(scoped, check.column, check.parent, check.parent_column)
        lost = orphans.agg(F.sum("rows").alias("failing")).withColumn("total", F.lit(None).cast("bigint"))
        rows = scoped.agg(F.count(F.lit(1)).alias("total")).withColumn(
            "failing", F.lit(None).cast("bigint")
        )
        both = lost.unionByName(rows)
        return _one(check, both.agg(F.max("failing").alias("failing"), F.max("total").alias("total")))
    return _one(check, per_value.agg(bad.alias("failing"), total))


GROUPED = ("unique", "distinct_in_set", "relationships")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check. Row-level checks share a single scan; value checks add one each."""
    simple = [c for c in checks if c.kind not in GROUPED]
    parts = [_one_pass(df, simple)] if simple else []
    parts += [_grouped(df, c) for c in checks if c.kind in GROUPED]
    return reduce(DataFrame.unionByName, parts)


def singular(name: str, failing_rows: DataFrame, severity: str = ERROR) -> DataFrame:
    """A check written as a query: any row it returns is a failure."""
    counted = failing_rows.agg(F.count(F.lit(1)).alias("failing")).withColumn("total", F.col("failing"))
    return _one(Check("singular", name=name, severity=severity), counted)


def same_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(left_rows, right_rows)`` as one row when the counts differ, else no row."""
    both = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
    )
    return counts.where("left_rows != right_rows")


def contract_check(
    df: DataFrame, contract: T.StructType | str, name: str = "schema", types: bool = True
) -> DataFrame:
    """One row per column that is missing, extra or of another type; no row means agreement.

    Reads the schema only. Without ``types`` names alone count, as for text files.
    """
    if isinstance(contract, str):
        contract = T.StructType.fromDDL(contract)
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    problems = [(name, c, "missing", want[c], None) for c in want if c not in have]
    problems += [(name, c, "extra", None, have[c]) for c in have if c not in want]
    problems += [
        (name, c, "type", want[c], have[c]) for c in want if types and c in have and want[c] != have[c]
    ]
    return df.sparkSession.createDataFrame(
        problems, "contract string, column string, problem string, expected string, found string"
    )


def freshness(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``source, rows, latest`` for each source and its load-time column."""
    parts = [
        df.agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("rows"),
            F.max(F.col(ts).cast("timestamp")).alias("latest"),
        )
        for name, (df, ts) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def fresh_enough(report: DataFrame, moment: str, warn_days: float, error_days: float) -> DataFrame:
    """The rows of :func:`freshness` as checks: how old each source is at ``moment``, against two limits.

    A source without rows fails as an error. ``moment`` is an argument and never the clock, so a rerun gives the same rows.
    """
    age = (F.lit(moment).cast("timestamp").cast("double") - F.col("latest").cast("double")) / 86400
    stale, late = F.coalesce(age > error_days, F.lit(True)), F.coalesce(age > warn_days, F.lit(True))
    return report.select(
        F.concat(F.lit("freshness_"), "source").alias("check"),
        F.when(late & ~stale, F.lit(WARN)).otherwise(F.lit(ERROR)).alias("severity"),
        F.when(late, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("failing"),
        F.lit(1).cast("long").alias("total"),
        F.round(age, 6).alias("observed"),
        (~late).alias("passed"),
    )


class QualityGateError(RuntimeError):
    """Raised when a blocking check fails; carries the failed checks."""

    def __init__(self, failed: list[str]):
        super().__init__("blocked by: " + ", ".join(failed))
        self.failed = failed


def gate(results: DataFrame) -> None:
    """Raise when an error-severity check failed. Warnings pass.

    Runs the checks and brings the names of failed ones to the driver: one row per check.
    """
    rows = results.where((F.col("severity") == ERROR) & ~F.col("passed")).select("check").collect()
    if rows:
        raise QualityGateError(sorted(r["check"] for r in rows))
