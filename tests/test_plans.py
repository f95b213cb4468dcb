"""Physical plans: what must not be there, and what must be."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from conform.functions.keys import surrogate_key
from conform.operators import history, reshape, star
from conform.operators.star import Lookup
from conform.plans import checks, cleaning, functions, histories, matching, stars
from conform.plans.registry import table

SF = "/root/testdata/sf0.001"
LAZY = {m.__name__ for m in (checks, cleaning, functions, histories, matching, stars)}
NAMES = sorted(n for n, q in spark_entry.queries().items() if q.__module__ in LAZY and n != "trace_back")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark_entry.queries()[name](spark, SF))
    for banned in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in text


def test_filters_and_columns_reach_the_scan(spark):
    customers = table(spark, SF, "customer").where("c_nationkey = 3").select("c_custkey")
    text = plan(customers)
    assert "EqualTo(c_nationkey,3)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text


def test_scd1_reads_one_column(spark):
    text = plan(history.scd1_dim(table(spark, SF, "customer"), ["c_mktsegment"], "sk"))
    assert "ReadSchema: struct<c_mktsegment:string>" in text


def test_unpivot_scans_once(spark):
    wide = table(spark, SF, "customer").select("c_custkey", F.col("c_acctbal").alias("a"), F.col("c_acctbal").alias("b"))
    text = plan(reshape.unpivot_clamp(wide, ["c_custkey"], ["a", "b"], "k", "v"))
    assert text.count("FileScan") == 1 and "Expand" in text


def test_a_scrub_runs_its_regex_once(spark):
    pages = table(spark, SF, "pages")
    text = plan(reshape.scrub_and_flag(pages, "url", "[?#]", "reason"))
    assert text.count("RLIKE") == 1


def test_a_fact_over_small_dimensions_is_not_shuffled(spark):
    lines, part = table(spark, SF, "lineitem"), table(spark, SF, "part")
    keyed = part.withColumn("part_sk", surrogate_key("p_partkey"))
    fact = star.build_fact(
        lines,
        "line_sk",
        ["l_orderkey", "l_linenumber"],
        [Lookup(keyed, {"l_partkey": "p_partkey"}, {"part_sk": "part_sk"})],
        ["l_quantity"],
    )
    text = plan(fact)
    # One exchange: the dimension's keys are counted, so that a doubled one fails. The fact's rows stay where they are.
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1
    assert "l_" not in next(x for x in text.splitlines() if "Exchange hashpartitioning" in x)
    assert "l_comment" not in text and "l_tax" not in text
