"""Every registered query against its SQL oracle, and the shape of the contract."""

from __future__ import annotations

import pytest
from compare import connect, difference, spark_rows

import __spark_entry__ as spark_entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_agrees_with_its_oracle(spark, con, name):
    assert difference(spark, con, name, SF) is None


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(spark_entry.oracle_sql())))
def test_query_without_oracle_gives_rows(spark, name):
    assert spark_rows(spark, name, SF)[1]


def test_quality_gate_outcomes(spark):
    rows = {r["run"]: r for r in spark_entry.queries()["quality_gate"](spark, SF).collect()}
    assert set(rows) == {"empty", "failed_check"}
    assert all(r["current"] == "good" for r in rows.values())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["line_sk", "date_sk", "weekday_name", "l_quantity", "l_extendedprice"]
    assert df.limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
