"""Queries on type-2 history: customers seen in two feeds.

The second feed moves customers in arrears to no segment, loses the last nation's
customers, and takes suppliers in as new customers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators import history, late, reconcile, reshape
from conform.plans.registry import query, table

DAY1, DAY2, DAY3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
KEYS, CHECKED = ["c_custkey"], ["c_nationkey", "c_mktsegment"]
COLS = [*KEYS, "c_name", *CHECKED]
SUPPLIER_BASE = 1_000_000_000

FEEDS_SQL = f"""
    with feed1 as (select c_custkey, c_name, c_nationkey, c_mktsegment from customer),
    feed2 as (
        select c_custkey, c_name, c_nationkey,
               case when c_acctbal >= 0 then c_mktsegment end as c_mktsegment
        from customer where c_nationkey <> 24
        union all
        select s_suppkey + {SUPPLIER_BASE}, s_name, s_nationkey, 'SUPPLIER' from supplier),
    hist1 as (
        select *, timestamp '{DAY1}' as valid_from, cast(null as timestamp) as valid_to from feed1),
    changed as (
        select n.* from feed2 n join feed1 o using (c_custkey)
        where n.c_nationkey is distinct from o.c_nationkey
           or n.c_mktsegment is distinct from o.c_mktsegment),
    hist2 as (
        select h.* replace (case when c.c_custkey is not null then timestamp '{DAY2}' end as valid_to)
        from hist1 h left join changed c using (c_custkey)
        union all
        select *, timestamp '{DAY2}', cast(null as timestamp) from changed
        union all
        select *, timestamp '{DAY2}', cast(null as timestamp) from feed2
        where c_custkey not in (select c_custkey from feed1))
"""


def feed1(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(*COLS)


def feed2(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").where("c_nationkey <> 24")
    supplier = table(spark, sf_dir, "supplier")
    in_credit = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return reshape.union_named(
        customer.withColumn("c_mktsegment", in_credit).select(*COLS),
        supplier.select(
            (F.col("s_suppkey") + SUPPLIER_BASE).alias("c_custkey"),
            F.col("s_name").alias("c_name"),
            F.col("s_nationkey").alias("c_nationkey"),
            F.lit("SUPPLIER").alias("c_mktsegment"),
        ),
    )


def history1(spark, sf_dir):
    return history.scd2_check(None, feed1(spark, sf_dir), KEYS, CHECKED, DAY1)


def history2(spark, sf_dir):
    return history.scd2_check(
        history1(spark, sf_dir), feed2(spark, sf_dir), KEYS, CHECKED, DAY2
    )


@query("scd2_first", f"{FEEDS_SQL} select * from hist1")
def scd2_first(spark, sf_dir):
    return history1(spark, sf_dir)


@query("scd2_second", f"{FEEDS_SQL} select * from hist2")
def scd2_second(spark, sf_dir):
    return history2(spark, sf_dir)


@query("scd2_replay", f"{FEEDS_SQL} select * from hist2")
def scd2_replay(spark, sf_dir):
    """The second feed again a day later: nothing changes."""
    again = feed2(spark, sf_dir)
    return history.scd2_check(history2(spark, sf_dir), again, KEYS, CHECKED, DAY3)


@query(
    "scd2_close_missing",
    f"""
    {FEEDS_SQL}
    select h.* replace (case when h.valid_to is null and n.c_custkey is null then timestamp '{DAY2}'
                             else h.valid_to end as valid_to)
    from hist2 h left join feed2 n using (c_custkey)
    """,
)
def scd2_close_missing(spark, sf_dir):
    """The option that closes withdrawn keys."""
    return history.scd2_check(
        history1(spark, sf_dir), feed2(spark, sf_dir), KEYS, CHECKED, DAY2, close_missing=True
    )


@query(
    "scd2_as_of",
    f"""
    {FEEDS_SQL} select * from hist2
    where valid_from <= timestamp '2024-01-01 12:00:00'
      and (valid_to is null or valid_to > timestamp '2024-01-01 12:00:00')
    """,
)
def scd2_as_of(spark, sf_dir):
    return history.as_of(history2(spark, sf_dir), "2024-01-01 12:00:00")


@query(
    "scd2_audited",
    f"""
    {FEEDS_SQL}
    select *, md5(cast(c_custkey as varchar) || '|' || cast(valid_from as varchar)) as scd_id,
           valid_from as updated_at
    from hist2
    """,
)
def scd2_audited(spark, sf_dir):
    return history.audited(history2(spark, sf_dir), KEYS)


@query(
    "feed_delta",
    f"""
    {FEEDS_SQL}
    select coalesce(o.c_custkey, n.c_custkey) as c_custkey,
           case when o.c_custkey is null then 'added'
                when n.c_custkey is null then 'withdrawn' else 'changed' end as change,
           case when o.c_custkey is null or n.c_custkey is null then ''
                else concat_ws(',',
                     case when o.c_nationkey is distinct from n.c_nationkey then 'c_nationkey' end,
                     case when o.c_mktsegment is distinct from n.c_mktsegment then 'c_mktsegment' end)
           end as changed_cols
    from feed1 o full join feed2 n on o.c_custkey = n.c_custkey
    where o.c_custkey is null or n.c_custkey is null
       or o.c_nationkey is distinct from n.c_nationkey
       or o.c_mktsegment is distinct from n.c_mktsegment
    """,
)
def feed_delta(spark, sf_dir):
    delta = reconcile.feed_delta(feed1(spark, sf_dir), feed2(spark, sf_dir), KEYS, CHECKED)
    return delta.withColumn("changed_cols", F.array_join("changed_cols", ","))


@query(
    "scd2_late_feed",
    f"""
    {FEEDS_SQL}
    select f.*, timestamp '{DAY1}' as valid_from, case when c.c_custkey is not null then timestamp '{DAY2}' end as valid_to
    from feed1 f left join changed c using (c_custkey)
    union all select *, timestamp '{DAY2}', timestamp '{DAY3}' from changed
    union all select f.*, timestamp '{DAY3}', cast(null as timestamp) from feed1 f where c_custkey in (select c_custkey from changed)
    union all select *, timestamp '{DAY2}', cast(null as timestamp) from feed2 where c_custkey not in (select c_custkey from feed1)
    """,
)
def scd2_late_feed(spark, sf_dir):
    """The second day's feed comes last, after a third that brings the first one's rows again: it splits their versions."""
    feeds = [(DAY1, feed1), (DAY3, feed1), (DAY2, feed2)]
    kept, times = None, []
    for at, feed in feeds:
        kept = late.insert_feed(kept, feed(spark, sf_dir), KEYS, at, times)
        times.append(at)
    return late.versions(kept)
