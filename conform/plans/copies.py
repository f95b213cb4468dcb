"""Queries on copies of a table: hash-tree reconciliation, bucketed upsert, writers that meet."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators import digests
from conform.plans.registry import query, table
from conform.plans.storage import new_lake
from conform.sources.buckets import BucketedTable
from conform.sources.lake import CommitConflict

KEYS, COLS = ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"]
ADDED = 1_000_000_000

# The copy lost the orders of some customers, reprices and reopens others, and has orders of its own.
COPIES_SQL = f"""
    with l as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders),
    r as (
        select o_orderkey, o_custkey,
               case when o_custkey % 17 = 3 then null else o_orderstatus end as o_orderstatus,
               case when o_custkey % 19 = 5 then o_totalprice + 1 else o_totalprice end as o_totalprice
        from orders where o_custkey % 23 <> 7
        union all
        select o_orderkey + {ADDED}, o_custkey, o_orderstatus, o_totalprice from orders where o_custkey % 29 = 11),
    b as (
        select coalesce(l.o_orderkey, r.o_orderkey) as o_orderkey, l.o_orderkey is not null as in_l, r.o_orderkey is not null as in_r,
               l.o_orderstatus is distinct from r.o_orderstatus as status, l.o_totalprice is distinct from r.o_totalprice as price
        from l full join r using (o_orderkey))
"""


def copies(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select(*KEYS, *COLS)
    customer = F.col("o_custkey")
    kept = left.where(customer % 23 != 7).withColumns({
        "o_orderstatus": F.when(customer % 17 != 3, F.col("o_orderstatus")),
        "o_totalprice": F.when(customer % 19 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    })
    own = left.where(customer % 29 == 11).withColumn("o_orderkey", F.col("o_orderkey") + ADDED)
    return left, kept.unionByName(own)


@query(
    "digest_reconcile",
    f"""
    {COPIES_SQL}
    select count(*) filter (where in_l) as left_rows, count(*) filter (where in_r) as right_rows,
           count(*) filter (where in_l and in_r) as keys_both, count(*) filter (where not in_r) as keys_left_only,
           count(*) filter (where not in_l) as keys_right_only,
           count(*) filter (where in_l and in_r and (status or price)) as keys_changed, false as passed
    from b
    """,
)
def digest_reconcile(spark, sf_dir):
    """Two copies of the orders compared by digests; what differs is read again and joined."""
    return digests.digest_reconcile(*copies(spark, sf_dir), KEYS, COLS).drop("leaves_differing", "rows_compared")


@query(
    "digest_differences",
    f"""
    {COPIES_SQL}
    select o_orderkey, case when not in_r then 'left_only' when not in_l then 'right_only' else 'changed' end as change,
           case when in_l and in_r then concat_ws(',', case when status then 'o_orderstatus' end, case when price then 'o_totalprice' end)
                else '' end as changed_cols
    from b where not (in_l and in_r) or status or price
    """,
)
def digest_differences(spark, sf_dir):
    """The work list behind the digests: which keys differ, and in which columns."""
    found = digests.digest_differences(*copies(spark, sf_dir), KEYS, COLS)
    return found.withColumn("changed_cols", F.array_join("changed_cols", ","))


def bucketed_orders(spark, sf_dir, purpose):
    lake = new_lake(spark, purpose)
    orders = table(spark, sf_dir, "orders").select(*KEYS, *COLS)
    stored = BucketedTable(lake, lake.silver("orders"), KEYS)
    stored.replace(orders)
    return orders, stored


@query(
    "upsert_buckets",
    f"""
    select o_orderkey, o_custkey, o_orderstatus,
           case when o_custkey = (select min(o_custkey) from orders) then o_totalprice * 2 else o_totalprice end as o_totalprice
    from orders where o_custkey <> (select max(o_custkey) from orders)
    union all
    select o_orderkey + {ADDED}, o_custkey, o_orderstatus, o_totalprice from orders
    where o_custkey = (select min(o_custkey) from orders)
    """,
)
def upsert_buckets(spark, sf_dir):
    """One customer's orders repriced and repeated under new keys, another's deleted: other buckets are left alone."""
    orders, stored = bucketed_orders(spark, sf_dir, "buckets")
    ends = orders.agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi")).first()
    some = orders.where(F.col("o_custkey") == ends["lo"])
    doubled = some.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    again = some.withColumn("o_orderkey", F.col("o_orderkey") + ADDED)
    stored.upsert(doubled.unionByName(again), deleted=orders.where(F.col("o_custkey") == ends["hi"]))
    return stored.read().drop("bucket")


@query(
    "publish_conflict",
    """
    select 'second' as current, count(*) as customers, true as refused from customer where c_acctbal >= 0
    """,
)
def publish_conflict(spark, sf_dir):
    """Two writers build on the same published run: the first to publish stands, the other is refused."""
    lake = new_lake(spark, "conflict")
    customer = table(spark, sf_dir, "customer")
    for run_id, rows in (("first", customer), ("second", customer.where("c_acctbal >= 0")), ("third", customer.where("c_acctbal < 0"))):
        lake.write_model(rows.agg(F.count(F.lit(1)).alias("customers")), lake.gold(run_id, "customers"))
    lake.publish("first", ["customers"])
    lake.publish("second", ["customers"], expected="first")
    refused = False
    try:
        lake.publish("third", ["customers"], expected="first")
    except CommitConflict:
        refused = True
    return lake.read_current("customers").select(F.lit(lake.current_run()).alias("current"), "customers", F.lit(refused).alias("refused"))
