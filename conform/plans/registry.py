"""Registry of the checked queries: each has a Spark plan and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from conform.functions.keys import NULL_TOKEN

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql.strip()
        return plan

    return add


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def key_sql(*exprs: str) -> str:
    """Oracle text of the surrogate key."""
    return "md5(" + " || '-' || ".join(f"coalesce(cast({e} as varchar), '{NULL_TOKEN}')" for e in exprs) + ")"


def norm_sql(expr: str) -> str:
    """Oracle text of name normalisation."""
    return f"regexp_replace(lower(trim({expr})), '[^a-z0-9]', '', 'g')"
