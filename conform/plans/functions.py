"""Queries on the everyday functions an analyst of the mart uses, in the Spark form.

Windows and lists run over aggregates whose group size is bounded (days, event types),
so a hot user or type never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from conform.operators import closure
from conform.operators.history import upsert
from conform.plans import histories
from conform.plans.registry import query, table

DAILY_SQL = """
    select cast(ts as date) as day, event_type, count(*) as n
    from events group by all
"""


def daily(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "fn_ranks",
    f"""
    select day, event_type, n,
           cast(row_number() over (partition by event_type order by n desc, day) as integer) as rn,
           cast(rank() over (partition by event_type order by n desc) as integer) as rnk,
           cast(dense_rank() over (partition by event_type order by n desc) as integer) as dense
    from ({DAILY_SQL})
    """,
)
def fn_ranks(spark, sf_dir):
    by_n = Window.partitionBy("event_type").orderBy(F.desc("n"))
    return daily(spark, sf_dir).select(
        "day",
        "event_type",
        "n",
        F.row_number().over(by_n.orderBy(F.desc("n"), "day")).alias("rn"),
        F.rank().over(by_n).alias("rnk"),
        F.dense_rank().over(by_n).alias("dense"),
    )


@query(
    "fn_neighbours",
    f"""
    select day, event_type, n,
           coalesce(lag(n) over w, -1) as before, coalesce(lead(n) over w, -1) as after,
           first_value(n) over w as first_n, last_value(n) over w as last_n
    from ({DAILY_SQL}) window w as (partition by event_type order by day)
    """,
)
def fn_neighbours(spark, sf_dir):
    w = Window.partitionBy("event_type").orderBy("day")
    return daily(spark, sf_dir).select(
        "day",
        "event_type",
        "n",
        F.lag("n", 1, -1).over(w).alias("before"),
        F.lead("n", 1, -1).over(w).alias("after"),
        F.first("n").over(w).alias("first_n"),
        F.last("n").over(w).alias("last_n"),
    )


@query(
    "fn_dates",
    """
    select o_orderkey, cast(o_orderdate + interval 30 day as date) as due,
           date_diff('day', cast(o_orderdate as date), date '2002-01-01') as age,
           cast(date_trunc('month', o_orderdate) as date) as month_start,
           cast(extract(quarter from o_orderdate) as integer) as quarter,
           strftime(o_orderdate, '%Y-%m') as month_text
    from orders
    """,
)
def fn_dates(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(day, 30).alias("due"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).cast("bigint").alias("age"),
        F.trunc(day, "month").alias("month_start"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("month_text"),
    )


@query(
    "fn_lists",
    """
    select user_id, string_agg(event_type, ',' order by event_type) as types,
           array_to_string(list(n order by event_type), ',') as counts
    from (select user_id, event_type, count(*) as n from events group by all)
    group by user_id
    """,
)
def fn_lists(spark, sf_dir):
    """Lists per user over its distinct event types, of which there are five."""
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    return (
        counted.groupBy("user_id")
        .agg(pairs.alias("p"))
        .select(
            "user_id",
            F.array_join("p.event_type", ",").alias("types"),
            F.array_join(F.col("p.n").cast("array<string>"), ",").alias("counts"),
        )
    )


@query(
    "fn_quantiles",
    """
    select l_returnflag, quantile_cont(l_quantity, 0.5) as median,
           quantile_cont(l_quantity, 0.9) as p90, true as distinct_is_close
    from lineitem group by l_returnflag
    """,
)
def fn_quantiles(spark, sf_dir):
    """Exact percentiles of a column with few values, and a distinct count within 20 %.

    The exact distinct count is taken over deduplicated pairs, which Spark reduces
    map-side, so the flag that most rows carry is not sent to one task row by row.
    """
    lines = table(spark, sf_dir, "lineitem")
    quantiles = lines.groupBy("l_returnflag").agg(
        F.expr("percentile(l_quantity, 0.5)").alias("median"),
        F.expr("percentile(l_quantity, 0.9)").alias("p90"),
        F.approx_count_distinct("l_orderkey").alias("estimate"),
    )
    pairs = lines.select("l_returnflag", "l_orderkey").distinct()
    exact = pairs.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("exact"))
    close = (F.col("estimate") / F.col("exact")).between(0.8, 1.2)
    return quantiles.join(exact, "l_returnflag").select(
        "l_returnflag", "median", "p90", close.alias("distinct_is_close")
    )


@query(
    "fn_json",
    """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
           '{"id":' || event_id || ',"type":"' || event_type || '"}' as packed
    from events
    """,
)
def fn_json(spark, sf_dir):
    parsed = F.from_json("props", "k bigint")
    packed = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))
    return table(spark, sf_dir, "events").select(
        "event_id", parsed["k"].alias("k"), packed.alias("packed")
    )


@query(
    "fn_variant",
    """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
           try_cast(event_type as integer) is null as not_a_number,
           case when value > 50 then 'high' else 'low' end as band
    from events
    """,
)
def fn_variant(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"),
        F.col("event_type").try_cast("int").isNull().alias("not_a_number"),
        F.expr("if(value > 50, 'high', 'low')").alias("band"),
    )


@query(
    "fn_explode",
    """
    select doc_id, word, count(*) as n
    from (select doc_id, unnest(string_split(lower(text), ' ')) as word from documents)
    group by all
    """,
)
def fn_explode(spark, sf_dir):
    """Flattened words of whole texts, counted per document."""
    words = F.explode(F.split(F.lower("text"), " "))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", words.alias("word"))
        .groupBy("doc_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "fn_nulls",
    """
    select d.doc_id, coalesce(l.quality, -1) as quality, l.quality is null as is_unlabelled,
           case when l.toxic = 1 then 'toxic' when l.toxic = 0 then 'clean' else 'unknown' end as verdict
    from documents d left join labels l using (doc_id)
    """,
)
def fn_nulls(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    joined = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic = F.col("toxic")
    return joined.withColumn("is_unlabelled", F.col("quality").isNull()).fillna({"quality": -1}).select(
        "doc_id",
        "quality",
        "is_unlabelled",
        F.when(toxic == 1, "toxic").when(toxic == 0, "clean").otherwise("unknown").alias("verdict"),
    )


@query(
    "fn_best_per_group",
    """
    select o_custkey, o_orderkey, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1
    """,
)
def fn_best_per_group(spark, sf_dir):
    """QUALIFY as a filter on the rank; rows are cut before the shuffle."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@query(
    "fn_recursive",
    """
    with recursive months(m, last) as (
        select date_trunc('month', min(o_orderdate)), max(o_orderdate) from orders
        union all
        select m + interval 1 month, last from months where m + interval 1 month <= last)
    select cast(m as date) as month_start, count(o_orderkey) as orders
    from months left join orders on date_trunc('month', o_orderdate) = m group by m
    """,
)
def fn_recursive(spark, sf_dir):
    """A recursive table of months, joined to the orders counted per month. The recursion goes as deep as the orders' dates ask for."""
    return months_with_orders(spark, table(spark, sf_dir, "orders"))


def months_with_orders(spark, orders):
    orders.createOrReplaceTempView("fn_recursive_orders")
    first = F.trunc(F.min("o_orderdate"), "month")
    span = orders.agg(F.ceil(F.months_between(F.max("o_orderdate"), first)).alias("months")).first()
    return spark.sql(
        f"""
        with recursive span as (
            select cast(trunc(min(o_orderdate), 'month') as date) as first,
                   cast(max(o_orderdate) as date) as last
            from fn_recursive_orders),
        months(m, last) max recursion level {(span["months"] or 0) + 2} as (
            select first, last from span
            union all
            select cast(add_months(m, 1) as date), last from months where add_months(m, 1) <= last),
        counted as (
            select cast(trunc(o_orderdate, 'month') as date) as m, count(*) as n
            from fn_recursive_orders group by 1)
        select months.m as month_start, coalesce(n, 0) as orders
        from months left join counted on months.m = counted.m
        """
    )


@query(
    "fn_describe",
    """
    select c_mktsegment, count(c_acctbal) as n, min(c_acctbal) as lowest, max(c_acctbal) as highest,
           round(avg(c_acctbal), 4) as mean, round(stddev_samp(c_acctbal), 4) as deviation
    from customer group by c_mktsegment
    """,
)
def fn_describe(spark, sf_dir):
    c = "c_acctbal"
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.count(c).alias("n"),
        F.min(c).alias("lowest"),
        F.max(c).alias("highest"),
        F.round(F.avg(c), 4).alias("mean"),
        F.round(F.stddev_samp(c), 4).alias("deviation"),
    )


@query("fn_distinct_rows", "select distinct o_custkey, cast(o_orderdate as date) as day from orders")
def fn_distinct_rows(spark, sf_dir):
    day = F.to_date("o_orderdate").alias("day")
    return table(spark, sf_dir, "orders").select("o_custkey", day).dropDuplicates()


@query("fn_sample", "select * from orders where substr(md5(cast(o_orderkey as varchar)), 1, 2) < '1a'")
def fn_sample(spark, sf_dir):
    """About a tenth of the orders, chosen by a hash of the key: the same rows from any copy of the table."""
    return table(spark, sf_dir, "orders").where(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 2) < "1a")


@query(
    "upsert",
    f"""
    {histories.FEEDS_SQL}
    select * from feed1 where c_custkey not in (select c_custkey from feed2)
    union all select * from feed2
    """,
)
def upsert_rows(spark, sf_dir):
    """A feed merged into a table without history."""
    return upsert(histories.feed1(spark, sf_dir), histories.feed2(spark, sf_dir), histories.KEYS)


CHAIN = 10_000  # levels of a chain of orders


@query(
    "closure_semi_naive",
    f"""
    with o as (select o_orderkey as k, o_orderkey - (o_orderkey % {CHAIN}) as start from orders),
    gaps as (  -- the first order of a run of keys without a hole, within its chain
        select o.k, max(case when p.k is null or o.k = o.start then o.k end) over (order by o.k) as root
        from o left join o p on p.k = o.k - 1)
    select k as o_orderkey, root, k - root as depth from gaps
    """,
)
def closure_semi_naive(spark, sf_dir):
    """Each order follows the one before it, in chains of ``CHAIN`` levels: root and depth of all of them."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(key, F.when(key % CHAIN != 0, key - 1).alias("before"))
    return closure.hierarchy(orders, "o_orderkey", "before")
