"""Queries on data quality and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators import quality as q, reconcile, reshape
from conform.operators.history import scd1_dim
from conform.plans.cleaning import LINE_DEDUPED, LINE_KEYS, LINE_ORDER
from conform.plans.registry import query, table
from conform.plans.stars import CONFORMED_SQL, LINE_FACT_SQL, line_fact, part_dim


def _check_sql(rows: list[tuple[str, str, str, str, str | None]]) -> str:
    """Rows of (check, severity, failing, total, source, observed)."""
    return " union all ".join(
        f"""select '{name}' as "check", '{severity}' as severity, cast({failing} as bigint) as failing,
            cast({total} as bigint) as total, ({failing}) = 0 as passed from {source}"""
        for name, severity, failing, total, source in rows
    )


def _count(where: str) -> str:
    return f"count(*) filter (where {where})"


LINES = "lineitem"
DUPLICATED_ORDERS = (
    "(select l_orderkey, count(*) as n from lineitem where l_orderkey is not null group by 1)"
)


@query(
    "dq_generic",
    _check_sql(
        [
            ("not_null_l_orderkey", "error", _count("l_orderkey is null"), "count(*)", LINES),
            ("accepted_values_l_returnflag", "error", _count("l_returnflag not in ('A', 'N')"), "count(*)", LINES),
            ("accepted_range_l_discount", "error", _count("l_discount < 0 or l_discount > 0.05"), "count(*)", LINES),
            ("returned_tax_range", "warn", _count("l_returnflag = 'R' and l_tax > 0.02"),
             _count("l_returnflag = 'R'"), LINES),
            ("unique_l_orderkey", "error", _count("n > 1"), "sum(n)", DUPLICATED_ORDERS),
            ("relationships_l_partkey", "error", _count("p_partkey is null"), "count(*)",
             "lineitem left join part on p_partkey = l_partkey"),
            ("relationships_o_orderkey", "warn", _count("not hit"), "count(*)",
             "(select o_orderkey in (select l_orderkey from lineitem) as hit from orders)"),
        ]
    ),
)
def dq_generic(spark, sf_dir):
    """Generic checks: null, set, range, scoped range, unique, parent exists."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    results = q.run_checks(
        lines,
        [
            q.not_null("l_orderkey"),
            q.accepted_values("l_returnflag", ["A", "N"]),
            q.accepted_range("l_discount", 0, 0.05),
            q.accepted_range(
                "l_tax", high=0.02, where="l_returnflag = 'R'", severity=q.WARN, name="returned_tax_range"
            ),
            q.unique("l_orderkey"),
            q.relationships("l_partkey", part, "p_partkey"),
        ],
    ).unionByName(
        q.run_checks(orders, [q.relationships("o_orderkey", lines, "l_orderkey", severity=q.WARN)])
    )
    return results.drop("observed")


@query(
    "dq_suite",
    f"""
    with j as (select l.quality from documents d left join labels l using (doc_id))
    select 'row_count' as "check", 'error' as severity, cast(count(*) < 100 as bigint) as failing,
           count(*) as total, cast(count(*) as double) as observed, count(*) >= 100 as passed from j
    union all
    select 'proportion_not_null_quality', 'error', cast(count(quality) / count(*) < 0.65 as bigint),
           count(*), round(count(quality) / count(*), 6), count(quality) / count(*) >= 0.65 from j
    union all
    select 'accepted_range_quality', 'error', count(*) filter (where quality not between 0 and 1),
           count(*), count(*) filter (where quality not between 0 and 1),
           count(*) filter (where quality not between 0 and 1) = 0 from j
    union all
    select 'distinct_in_set_lang', 'error', count(*) filter (where lang not in ('en', 'fr', 'de')),
           (select count(*) from documents), count(*) filter (where lang not in ('en', 'fr', 'de')),
           count(*) filter (where lang not in ('en', 'fr', 'de')) = 0
    from (select distinct lang from documents)
    union all
    select 'unique_doc_id', 'error', count(*) filter (where n > 1), cast(sum(n) as bigint),
           count(*) filter (where n > 1), count(*) filter (where n > 1) = 0
    from (select doc_id, count(*) as n from documents group by 1)
    """,
)
def dq_suite(spark, sf_dir):
    """Suite of expectations: row-count band, resolved share, value set."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = documents.join(labels, "doc_id", "left")
    results = q.run_checks(
        joined,
        [
            q.row_count(low=100),
            q.proportion_not_null("quality", 0.65, 1.0),
            q.accepted_range("quality", 0, 1),
        ],
    ).unionByName(
        q.run_checks(
            documents, [q.distinct_in_set("lang", ["en", "fr", "de"]), q.unique("doc_id")]
        )
    )
    return results.withColumn("observed", F.round("observed", 6))


@query(
    "dq_singular",
    f"""
    with dim as ({CONFORMED_SQL}),
    sizes as (
        select (select count(*) from dim where member_type = 'part_type') as l,
               (select count(distinct p_type) from part) as r),
    gaps as (
        select (select count(*) from orders) as l, (select count(distinct l_orderkey) from lineitem) as r)
    select 'category_members' as "check", 'error' as severity, count(*) as failing, count(*) as total,
           count(*) = 0 as passed from sizes where l <> r
    union all
    select 'order_counts', 'warn', count(*), count(*), count(*) = 0 from gaps where l <> r
    """,
)
def dq_singular(spark, sf_dir):
    """Checks written as queries: one that holds and one that does not."""
    members = part_dim(spark, sf_dir).where("member_type = 'part_type'")
    types = scd1_dim(table(spark, sf_dir, "part"), ["p_type"], "type_sk")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return (
        q.singular("category_members", q.same_count(members, types))
        .unionByName(
            q.singular("order_counts", q.same_count(table(spark, sf_dir, "orders"), lines), q.WARN)
        )
        .drop("observed")
    )


@query(
    "source_freshness",
    """
    select 'events' as source, count(*) as rows, max(ts) as latest from events
    union all select 'orders', count(*), max(o_orderdate) from orders
    union all select 'lineitem', count(*), max(l_shipdate) from lineitem
    """,
)
def source_freshness(spark, sf_dir):
    columns = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    return q.freshness({n: (table(spark, sf_dir, n), c) for n, c in columns.items()})


@query(
    "layer_reconcile",
    f"""
    with n as (
        select (select count(*) from lineitem) as raw, (select count(*) from ({LINE_DEDUPED})) as deduped,
               (select count(*) from ({LINE_FACT_SQL})) as fact,
               (select count(distinct cast(ts as date)) from events) as days)
    select 'raw_deduped' as "check", raw as upstream_rows, deduped as downstream_rows,
           round(1 - deduped / raw, 6) as drop_rate, 1 - deduped / raw between 0 and 0.05 as passed from n
    union all
    select 'raw_fact', raw, fact, round(1 - fact / raw, 6), fact = raw from n
    union all
    select 'wide_long', days, 5 * days, -4.0, true from n
    """,
)
def layer_reconcile(spark, sf_dir):
    """Row counts between layers: a bounded drop, a fact 1:1, an exact multiple."""
    from conform.plans.cleaning import EVENT_TYPES, event_days

    lines = table(spark, sf_dir, "lineitem")
    wide = event_days(spark, sf_dir)
    long = reshape.unpivot(wide, ["day"], EVENT_TYPES, "event_type", "v")
    report = reconcile.reconcile_layers(
        [
            reconcile.Hop(
                "raw_deduped", lines, reshape.dedupe_latest(lines, LINE_KEYS, LINE_ORDER), "drop"
            ),
            reconcile.Hop("raw_fact", lines, line_fact(spark, sf_dir)),
            reconcile.Hop("wide_long", wide, long, factor=len(EVENT_TYPES)),
        ]
    )
    return report.withColumn("drop_rate", F.round("drop_rate", 6))


@query(
    "keyset_reconcile",
    """
    with l as (select o_orderkey as k, count(*) as n from orders group by 1),
    r as (select l_orderkey as k, count(*) as n from lineitem group by 1)
    select cast(sum(coalesce(l.n, 0)) as bigint) as left_rows,
           cast(sum(coalesce(r.n, 0)) as bigint) as right_rows,
           count(*) filter (where l.k is not null and r.k is not null) as keys_both,
           count(*) filter (where r.k is null) as keys_left_only,
           count(*) filter (where l.k is null) as keys_right_only, false as passed
    from l full join r using (k)
    """,
)
def keyset_reconcile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return reconcile.reconcile_keys(orders, lines, ["k"])


@query(
    "one_sided_keys",
    """
    select coalesce(o.k, l.k) as k, case when l.k is null then 'left' else 'right' end as only_in
    from (select distinct o_orderkey as k from orders) o
    full join (select distinct l_orderkey as k from lineitem) l on o.k = l.k
    where o.k is null or l.k is null
    """,
)
def one_sided_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return reconcile.one_sided_keys(orders, lines, ["k"])
