from __future__ import annotations

import pytest

from conform.operators import quality as q

SCHEMA = "id int, kind string, n double, parent int"
ROWS = [(1, "a", 1.0, 10), (2, "b", 11.0, 99), (2, "z", None, None), (None, None, -1.0, 10)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(10,), (11,)], "pk int")


def failing(results):
    return {r["check"]: (r["failing"], r["total"], r["passed"]) for r in results.collect()}


def test_one_failing_row_per_kind(df, parent):
    got = failing(
        q.run_checks(
            df,
            [
                q.not_null("id"),
                q.unique("id"),
                q.accepted_values("kind", ["a", "b"]),
                q.accepted_range("n", 0, 10),
                q.relationships("parent", parent, "pk"),
                q.distinct_in_set("kind", ["a", "b"]),
            ],
        )
    )
    assert got == {
        "not_null_id": (1, 4, False),
        "unique_id": (1, 4, False),
        "accepted_values_kind": (1, 4, False),
        "accepted_range_n": (2, 4, False),
        "relationships_parent": (1, 4, False),
        "distinct_in_set_kind": (1, 4, False),
    }


def test_null_passes_value_checks(spark, parent):
    nulls = spark.createDataFrame([(None, None, None, None)] * 2, SCHEMA)
    got = failing(
        q.run_checks(
            nulls,
            [
                q.unique("id"),
                q.accepted_values("kind", ["a"]),
                q.accepted_range("n", 0, 1),
                q.relationships("parent", parent, "pk"),
                q.distinct_in_set("kind", ["a"]),
            ],
        )
    )
    assert all(v == (0, 2, True) for v in got.values())


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(1.0,), (10.0,)], "n double")
    assert failing(q.run_checks(df, [q.accepted_range("n", 1, 10)]))["accepted_range_n"][2]
    assert failing(q.run_checks(df, [q.accepted_range("n", low=0)]))["accepted_range_n"][2]


def test_where_scopes_a_check(df):
    got = failing(
        q.run_checks(df, [q.not_null("n", where="kind = 'a'"), q.not_null("n", where="kind = 'z'", name="z")])
    )
    assert got == {"not_null_n": (0, 1, True), "z": (1, 1, False)}


def test_counts_and_proportions(df):
    got = failing(
        q.run_checks(
            df,
            [
                q.row_count(4, 4, name="equal"),
                q.row_count(5, 9, name="band"),
                q.proportion_not_null("n", 0.75, 1.0),
                q.proportion_not_null("kind", 0.8, 1.0),
            ],
        )
    )
    assert got == {
        "equal": (0, 4, True),
        "band": (1, 4, False),
        "proportion_not_null_n": (0, 4, True),
        "proportion_not_null_kind": (1, 4, False),
    }


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = failing(
        q.run_checks(empty, [q.not_null("id"), q.unique("id"), q.row_count(low=1), q.proportion_not_null("n", 0.5)])
    )
    assert got == {
        "not_null_id": (0, 0, True),
        "unique_id": (0, 0, True),
        "row_count": (1, 0, False),
        "proportion_not_null_n": (1, 0, False),
    }


def test_row_checks_share_one_scan(df):
    results = q.run_checks(df, [q.not_null("id"), q.accepted_range("n", 0, 1), q.row_count(low=1)])
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_singular_and_same_count(spark, df):
    fine = q.singular("same", q.same_count(df, df))
    off = q.singular("other", q.same_count(df, df.limit(1)), q.WARN)
    assert failing(fine)["same"] == (0, 0, True)
    assert failing(off)["other"] == (1, 1, False)


def test_gate_blocks_errors_and_lets_warnings_pass(df):
    q.gate(q.run_checks(df, [q.not_null("id", severity=q.WARN), q.row_count(low=1)]))
    with pytest.raises(q.QualityGateError) as e:
        q.gate(q.run_checks(df, [q.not_null("id"), q.unique("id", severity=q.WARN)]))
    assert e.value.failed == ["not_null_id"]


def test_contract(spark, df, rows):
    from pyspark.sql import types as T

    want = T.StructType.fromDDL("id bigint, kind string, extra_wanted date, n double")
    got = rows(q.contract_check(df, want), "column", "problem")
    assert got == [("extra_wanted", "missing"), ("id", "type"), ("parent", "extra")]
    assert q.contract_check(df, df.schema).count() == 0


def test_unknown_kind(df):
    with pytest.raises(ValueError, match="unknown"):
        q.run_checks(df, [q.Check("sounds_right", "id")])


def test_stale_and_empty_sources_block(spark):
    from conform.operators import quality

    days = spark.createDataFrame([("2024-01-10 00:00:00",)], "ts string").selectExpr("cast(ts as timestamp) as ts")
    report = quality.freshness({"new": (days, "ts"), "empty": (days.limit(0), "ts")})
    severity = lambda moment: {
        r["check"]: (r["severity"], r["passed"]) for r in quality.fresh_enough(report, moment, 1.5, 2.0).collect()
    }
    assert severity("2024-01-11 00:00:00") == {"freshness_new": ("error", True), "freshness_empty": ("error", False)}
    assert severity("2024-01-11 18:00:00")["freshness_new"] == ("warn", False)
    assert severity("2024-01-13 00:00:00")["freshness_new"] == ("error", False)
    with pytest.raises(quality.QualityGateError, match="freshness_empty"):
        quality.gate(quality.fresh_enough(report, "2024-01-11 00:00:00", 1.5, 2.0))


def test_a_contract_on_names_alone(spark):
    from conform.operators import quality

    header = spark.createDataFrame([], "a string, c string")
    got = {(r["column"], r["problem"]) for r in quality.contract_check(header, "a int, b int", types=False).collect()}
    assert got == {("b", "missing"), ("c", "extra")}
