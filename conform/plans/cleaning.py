"""Queries on the cleaned tier: reshape, dedupe, scrub, parse."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.functions import dates, keys, text
from conform.operators import history, reshape
from conform.operators.reshape import clamp
from conform.plans.registry import key_sql, norm_sql, query, table

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    ("l_shipdate", "desc"), ("l_partkey", "asc"), ("l_suppkey", "asc"), ("l_quantity", "asc"),
    ("l_extendedprice", "asc"), ("l_discount", "asc"), ("l_tax", "asc"), ("l_returnflag", "asc"),
    ("l_linestatus", "asc"),
]
LINE_DEDUPED = """
    select * exclude (rn) from (
        select *, row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_shipdate desc nulls last, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                     l_discount, l_tax, l_returnflag, l_linestatus) as rn
        from lineitem)
    where rn = 1
"""
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("dedupe_latest", LINE_DEDUPED)
def dedupe_latest(spark, sf_dir):
    """One row per order line, the one shipped last."""
    return reshape.dedupe_latest(table(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER)


def event_days(spark, sf_dir):
    """Wide table: one row per day, one column of summed values per event type."""
    events = table(spark, sf_dir, "events")
    return (
        events.groupBy(F.to_date("ts").alias("day"))
        .pivot("event_type", EVENT_TYPES)
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double"))
    )


@query(
    "unpivot_clamp",
    """
    with per_day as (
        select cast(ts as date) as day, event_type,
               cast(sum(cast(value as decimal(18,2))) as double) as v
        from events group by all),
    grid as (
        select d.day, t.event_type
        from (select distinct day from per_day) d
        cross join (select unnest(['click','error','purchase','signup','view']) as event_type) t)
    select g.day, g.event_type,
           case when p.v - 600 < 0 then 0 else p.v - 600 end as net_value
    from grid g left join per_day p on p.day = g.day and p.event_type = g.event_type
    """,
)
def unpivot_clamp(spark, sf_dir):
    """Daily totals per type over a threshold, wide to long, shortfalls clamped to 0."""
    wide = event_days(spark, sf_dir)
    net = wide.select("day", *[(F.col(t) - 600).alias(t) for t in EVENT_TYPES])
    return reshape.unpivot_clamp(net, ["day"], EVENT_TYPES, "event_type", "net_value")


@query(
    "clamp_negative",
    "select c_custkey, case when c_acctbal < 0 then 0 else c_acctbal end as acctbal from customer",
)
def clamp_negative(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", clamp("c_acctbal").alias("acctbal"))


@query(
    "scrub_and_flag",
    """
    select page_id,
           case when not regexp_matches(url, '[?#]') then url end as url,
           coalesce(regexp_matches(url, '[?#]'), false) as dq_flag,
           case when regexp_matches(url, '[?#]') then 'url: query or fragment nulled' end as dq_reason
    from pages
    """,
)
def scrub_and_flag(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return reshape.scrub_and_flag(pages, "url", "[?#]", "url: query or fragment nulled")


@query(
    "scrub_markup",
    """
    select page_id, case when not regexp_matches(html, '<[^>]+>') then length(html) end as kept_chars,
           regexp_matches(html, '<[^>]+>') as dq_flag,
           case when regexp_matches(html, '<[^>]+>') then 'html: tag nulled' end as dq_reason
    from pages
    union all
    select doc_id, case when not regexp_matches(text, '<[^>]+>') then length(text) end,
           regexp_matches(text, '<[^>]+>'),
           case when regexp_matches(text, '<[^>]+>') then 'html: tag nulled' end
    from documents
    """,
)
def scrub_markup(spark, sf_dir):
    """The tag rule on whole texts: every page has a tag, no document has."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.col("text").alias("html")
    )
    both = reshape.union_named(pages, documents)
    flagged = reshape.scrub_and_flag(both, "html", text.HTML_TAG, "html: tag nulled")
    return flagged.select(
        "page_id", F.length("html").cast("bigint").alias("kept_chars"), "dq_flag", "dq_reason"
    )


SHAPES = {
    "tag": "<[^>]+>",
    "entity": "&[a-z]+;",
    "digits_only": r"\A[0-9]+\z",
    "blank": r"\A *\z",
    "query_or_fragment": "[?#]",
}


def _shape_sql(source: str, tbl: str, col: str) -> str:
    parts = [
        f"select '{source}' as source, '{n}' as shape,"
        f" count(*) filter (where regexp_matches({col}, '{p}')) as matching, count(*) as total from {tbl}"
        for n, p in SHAPES.items()
    ]
    parts.append(
        f"select '{source}', 'null', count(*) filter (where {col} is null), count(*) from {tbl}"
    )
    return " union all ".join(parts)


@query(
    "column_profile",
    " union all ".join(
        [
            _shape_sql("documents.text", "documents", "text"),
            _shape_sql("pages.html", "pages", "html"),
            _shape_sql("pages.url", "pages", "url"),
        ]
    ),
)
def column_profile(spark, sf_dir):
    """Counts of odd shapes per column, before a scrub rule is written."""
    parts = []
    for source in ("documents.text", "pages.html", "pages.url"):
        tbl, col = source.split(".")
        profile = reshape.shape_profile(table(spark, sf_dir, tbl), col, SHAPES)
        parts.append(profile.withColumn("source", F.lit(source)))
    return reshape.union_named(*parts)


@query(
    "normalise_text",
    f"select p_partkey, {norm_sql('p_brand')} as brand_norm, {norm_sql('p_name')} as name_norm from part",
)
def normalise_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.normalise("p_brand").alias("brand_norm"),
        text.normalise("p_name").alias("name_norm"),
    )


@query(
    "parse_dates",
    """
    select o_orderkey,
           cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') as date) as from_compact,
           cast(strptime(strftime(o_orderdate, '%d-%b-%y'), '%d-%b-%y') as date) as from_short,
           try_strptime(o_orderstatus, '%Y%m%d') is null as rejected
    from orders
    """,
)
def parse_dates(spark, sf_dir):
    """Two text formats parsed back; a text that is no date is rejected, not an error."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
        F.date_format("o_orderdate", "d-MMM-yy").alias("short"),
        "o_orderstatus",
        dates.parse_compact("o_orderstatus", strict=False).alias("_bad"),
    )
    return orders.select(
        "o_orderkey",
        dates.parse_compact("compact").alias("from_compact"),
        dates.parse_day_mon_yy("short").alias("from_short"),
        dates.unparsed("o_orderstatus", "_bad").alias("rejected"),
    )


@query(
    "flatten_arrays",
    """
    select user_id,
           array_to_string(list_sort(list(distinct event_type)), '; ') as event_types,
           list_sort(list(distinct event_type))[1] as first_type
    from events group by user_id
    """,
)
def flatten_arrays(spark, sf_dir):
    """The event types of each user, at most five, as text and as the first of them."""
    sets = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set("event_type")).alias("event_types"))
        .withColumn("first_type", F.col("event_types"))
    )
    return reshape.flatten(sets, joins=["event_types"], firsts=["first_type"])


@query(
    "surrogate_key",
    f"""
    select o_orderkey, {key_sql('o_custkey', 'cast(o_orderdate as date)')} as order_sk,
           cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_sk
    from orders
    """,
)
def surrogate_key(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        keys.surrogate_key("o_custkey", day).alias("order_sk"),
        keys.date_key(day).alias("date_sk"),
    )


@query(
    "union_named",
    """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
    """,
)
def union_named(spark, sf_dir):
    """Two parts of orders whose columns come in different order."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*cols)
    is_open = F.col("o_orderstatus") == "O"
    return reshape.union_named(orders.where(is_open), orders.where(~is_open).select(*reversed(cols)))


@query(
    "date_dim",
    """
    select cast(strftime(d, '%Y%m%d') as integer) as date_sk, cast(d as date) as full_date,
           cast(extract(year from d) as integer) as year, cast(extract(month from d) as integer) as month,
           cast(extract(day from d) as integer) as day, dayname(d) as weekday_name
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d
          from orders)
    """,
)
def date_dim(spark, sf_dir):
    """Calendar over the days the orders span."""
    return history.date_dim_covering(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "scd1_dim",
    f"""
    select {key_sql('c_mktsegment')} as segment_sk, c_mktsegment
    from (select distinct c_mktsegment from customer where c_mktsegment is not null)
    """,
)
def scd1_dim(spark, sf_dir):
    return history.scd1_dim(table(spark, sf_dir, "customer"), ["c_mktsegment"], "segment_sk")
