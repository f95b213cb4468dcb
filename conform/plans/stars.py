"""Queries on the star: conformed dimension, facts, serving tables, orphans, traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.functions import text
from conform.functions.keys import surrogate_key
from conform.operators import history, joins, match, reconcile, star, trace_index
from conform.operators.match import Seed
from conform.operators.reshape import dedupe_latest
from conform.operators.star import Lookup, Members
from conform.plans.cleaning import LINE_DEDUPED, LINE_KEYS, LINE_ORDER
from conform.plans.matching import match_sql
from conform.plans.registry import key_sql, norm_sql, query, table
from conform.session import sized, stored

SNAPSHOT_TS = "2024-01-01 00:00:00"
PART_MEMBERS = Members(
    key="part_sk",
    member_type="member_type",
    detail="part",
    category="part_type",
    natural_key="p_partkey",
    code="code",
    attributes=("p_name", "p_brand", "klass"),
    category_attributes={"p_name": "example", "klass": "hint"},
)
MEMBERS_SQL = """
    select p_partkey, p_name as name, case when p_size > 25 then p_type end as klass from part
"""
TYPES_SQL = "select p_type as code, p_type as hint, min(p_name) as example from part group by p_type"
CONFORMED_SQL = f"""
    select {key_sql('p.p_partkey', f"timestamp '{SNAPSHOT_TS}'")} as part_sk, 'part' as member_type,
           p.p_partkey, m.code, p.p_name, p.p_brand, case when p.p_size > 25 then p.p_type end as klass,
           m.match_confidence, m.is_combination_product,
           cast('2024-01-01' as date) as valid_from, cast(null as date) as valid_to, true as is_current
    from part p join ({match_sql(MEMBERS_SQL, TYPES_SQL)}) m using (p_partkey)
    union all
    select {key_sql('code')}, 'part_type', null, code, example, null, hint, null, false,
           cast('1900-01-01' as date), null, true
    from ({TYPES_SQL})
"""


def part_types(spark, sf_dir):
    """One category per part type, with its class hint and an example name."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("code"))
        .agg(F.first("p_type").alias("hint"), F.min("p_name").alias("example"))
    )


def part_dim(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("klass"),
    )
    types = part_types(spark, sf_dir)
    crosswalk = match.tiered_match(
        parts, Seed(types, "code", "hint", "example"), ["p_partkey"], "p_name", "klass"
    )
    return star.conformed_dim(
        history.first_snapshot(parts, SNAPSHOT_TS), crosswalk, types, PART_MEMBERS
    )


@query("conformed_dim", CONFORMED_SQL)
def conformed_dim(spark, sf_dir):
    return part_dim(spark, sf_dir)


EVENT_DAYS_SQL = """
    select cast(ts as date) as day, event_type,
           cast(sum(cast(value as decimal(18,2))) as double) as units, count(*) as n_events
    from events group by all
"""


@query(
    "category_fact",
    f"""
    select {key_sql('e.day', 'e.event_type')} as event_day_sk,
           cast(strftime(e.day, '%Y%m%d') as integer) as date_sk,
           {key_sql('e.event_type')} as type_sk, e.units, e.n_events
    from ({EVENT_DAYS_SQL}) e
    """,
)
def category_fact(spark, sf_dir):
    """Daily events per type, keyed to a calendar and to the type dimension."""
    events = table(spark, sf_dir, "events")
    facts = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("units"),
        F.count(F.lit(1)).alias("n_events"),
    )
    facts = stored(facts, "daily")  # read by the calendar, the types and the fact
    days = history.date_dim_covering(facts, "day")
    types = sized(history.scd1_dim(facts, ["event_type"], "type_sk"), "types")
    return star.build_fact(
        facts,
        "event_day_sk",
        ["day", "event_type"],
        [
            Lookup(days, {"day": "full_date"}, {"date_sk": "date_sk"}, size="fixed"),
            Lookup(types, {"event_type": "event_type"}, {"type_sk": "type_sk"}),
        ],
        ["units", "n_events"],
    )


LINE_FACT_SQL = f"""
    with dim as ({CONFORMED_SQL}),
    names as (
        select {norm_sql('p_name')} as name_norm, min(part_sk) as part_sk
        from dim where member_type = 'part' and is_current group by 1),
    facts as (
        select l.*, {norm_sql('p.p_name')} as name_norm
        from lineitem l join part p on p.p_partkey = l.l_partkey)
    select {key_sql('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} as line_sk,
           cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_sk, n.part_sk,
           {key_sql('l_returnflag')} as flag_sk, l_quantity, l_extendedprice
    from facts f left join names n using (name_norm)
"""
GRAIN = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def line_fact(spark, sf_dir):
    """Order lines that know their part only by name: resolved to one member per name."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    named = joins.lookup(
        lines, part, {"l_partkey": "p_partkey"}, {"p_name": "p_name"}, salt_by=LINE_KEYS
    )
    dim = part_dim(spark, sf_dir).where("member_type = 'part' and is_current")
    by_name = sized(joins.name_map(dim, "part_sk", ["p_name"]), "names")
    days = history.date_dim_covering(lines, "l_shipdate")
    flags = sized(history.scd1_dim(lines, ["l_returnflag"], "flag_sk"), "flags")
    facts = named.withColumns(
        {"name_norm": text.normalise("p_name"), "ship_date": F.to_date("l_shipdate")}
    )
    return star.build_fact(
        facts,
        "line_sk",
        GRAIN,
        [
            Lookup(days, {"ship_date": "full_date"}, {"date_sk": "date_sk"}, size="fixed"),
            Lookup(by_name, {"name_norm": "name_norm"}, {"part_sk": "part_sk"}),
            Lookup(flags, {"l_returnflag": "l_returnflag"}, {"flag_sk": "flag_sk"}),
        ],
        ["l_quantity", "l_extendedprice"],
    )


@query("event_fact", LINE_FACT_SQL)
def event_fact(spark, sf_dir):
    return line_fact(spark, sf_dir)


@query(
    "name_map",
    f"""
    select {norm_sql('p_name')} as name_norm, min({key_sql('p_partkey')}) as part_sk
    from part group by 1
    union all
    select {norm_sql('p_brand')}, min({key_sql('p_partkey')}) from part group by 1
    """,
)
def name_map(spark, sf_dir):
    """One key per normalised name over two name columns."""
    keyed = table(spark, sf_dir, "part").withColumn("part_sk", surrogate_key("p_partkey"))
    return joins.name_map(keyed, "part_sk", ["p_name", "p_brand"])


@query(
    "partial_left_join",
    """
    select d.doc_id, d.lang, cast(l.quality as varchar) as quality, cast(l.toxic as varchar) as toxic,
           l.doc_id is not null as is_labelled
    from documents d left join labels l using (doc_id)
    """,
)
def partial_left_join(spark, sf_dir):
    """Documents with their labels where there are any; the rest keep NULL."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", *[F.col(c).cast("string").alias(c) for c in ("quality", "toxic")]
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = labels.withColumn("hit", F.lit(True))
    take = {"quality": "quality", "toxic": "toxic", "hit": "is_labelled"}
    out = joins.lookup(documents, labelled, {"doc_id": "doc_id"}, take)
    return out.withColumn("is_labelled", F.coalesce("is_labelled", F.lit(False)))


@query(
    "salted_lookup",
    """
    select l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name, o.o_orderstatus
    from lineitem l left join supplier s on s.s_suppkey = l.l_suppkey
    join orders o on o.o_orderkey = l.l_orderkey
    """,
)
def salted_lookup(spark, sf_dir):
    """The plan for dimensions too large to broadcast: hot keys of the fact are spread."""
    lines = table(spark, sf_dir, "lineitem")
    supplier, orders = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    return star.serve(
        lines,
        ["l_orderkey", "l_linenumber", "l_partkey"],
        [
            Lookup(supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"}, size="salted"),
            Lookup(
                orders, {"l_orderkey": "o_orderkey"}, {"o_orderstatus": "o_orderstatus"}, "inner", "salted"
            ),
        ],
    )


@query(
    "key_coverage",
    """
    with j as (
        select l.quality, l.toxic from documents d left join labels l using (doc_id))
    select 'quality' as key, count(quality) as resolved, count(*) as total,
           round(count(quality) / count(*), 6) as share from j
    union all
    select 'toxic', count(toxic), count(*), round(count(toxic) / count(*), 6) from j
    """,
)
def key_coverage(spark, sf_dir):
    report = match.key_coverage(partial_left_join(spark, sf_dir), ["quality", "toxic"])
    return report.withColumn("share", F.round("share", 6))


@query(
    "serving_inner",
    """
    select o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name
    from orders o join customer c on c.c_custkey = o.o_custkey
    join nation n on n.n_nationkey = c.c_nationkey
    """,
)
def serving_inner(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return star.serve(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_totalprice"],
        [
            Lookup(
                customer,
                {"o_custkey": "c_custkey"},
                {"c_name": "c_name", "c_mktsegment": "c_mktsegment", "c_nationkey": "c_nationkey"},
                "inner",
            ),
            Lookup(nation, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}, "inner"),
        ],
    ).drop("c_nationkey")


@query(
    "serving_reduced",
    """
    select l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_name
    from lineitem l join part p on p.p_partkey = l.l_partkey where p.p_size > 45
    """,
)
def serving_reduced(spark, sf_dir):
    """Lines of the few parts that a filter leaves: a bitmap of their keys drops the other lines in the scan."""
    part = table(spark, sf_dir, "part").where("p_size > 45")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    few = joins.reduced(lines, part, {"l_partkey": "p_partkey"})
    kept = ["l_orderkey", "l_linenumber", "l_quantity"]
    return star.serve(few, kept, [Lookup(part, {"l_partkey": "p_partkey"}, {"p_name": "p_name"}, "inner")])


@query(
    "lookup_doubled",
    """
    select true as refused, count(*) as rows from orders
    """,
)
def lookup_doubled(spark, sf_dir):
    """A dimension that repeats a key would multiply the fact: the job fails, and with the key once more it goes through."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    take = {"c_name": "c_name"}
    refused = False
    try:
        twice = customer.unionByName(customer.where(F.col("c_custkey") == customer.agg(F.min("c_custkey")).scalar()))
        joins.lookup(orders, twice, {"o_custkey": "c_custkey"}, take).select("c_name").write.format("noop").mode("overwrite").save()
    except Exception as e:  # noqa: BLE001
        if "repeated key of a dimension" not in str(e):
            raise
        refused = True
    once = joins.lookup(orders, customer, {"o_custkey": "c_custkey"}, take)
    return once.agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("rows"))


@query(
    "serving_mixed",
    """
    with lines as (
        select l_orderkey, count(*) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
        from lineitem group by 1)
    select o.o_orderkey, c.c_mktsegment, cast(n_lines as varchar) as n_lines,
           cast(quantity as varchar) as quantity
    from orders o join customer c on c.c_custkey = o.o_custkey
    left join lines l on l.l_orderkey = o.o_orderkey
    """,
)
def serving_mixed(spark, sf_dir):
    """The customer must resolve; an order without lines stays, with NULLs."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).cast("string").alias("n_lines"),
            F.sum(F.col("l_quantity").cast("bigint")).cast("string").alias("quantity"),
        )
    )
    customer = table(spark, sf_dir, "customer")
    return star.serve(
        table(spark, sf_dir, "orders"),
        ["o_orderkey"],
        [
            Lookup(
                customer, {"o_custkey": "c_custkey"}, {"c_mktsegment": "c_mktsegment"}, "inner"
            ),
            Lookup(
                lines,
                {"o_orderkey": "l_orderkey"},
                {"n_lines": "n_lines", "quantity": "quantity"},
            ),
        ],
    )


@query(
    "fk_anti_join",
    """
    select 'labels_documents' as relation, doc_id as fk, count(*) as rows
    from labels where doc_id is not null and doc_id not in (select doc_id from documents) group by 2
    union all
    select 'orders_lineitem', o_orderkey, count(*)
    from orders where o_orderkey not in (select l_orderkey from lineitem) group by 2
    union all
    select 'lineitem_orders', l_orderkey, count(*)
    from lineitem where l_orderkey not in (select o_orderkey from orders) group by 2
    """,
)
def fk_anti_join(spark, sf_dir):
    pairs = [
        ("labels", "doc_id", "documents", "doc_id"),
        ("orders", "o_orderkey", "lineitem", "l_orderkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ]
    out = None
    for child, fk, parent, pk in pairs:
        orphans = joins.orphan_keys(table(spark, sf_dir, child), fk, table(spark, sf_dir, parent), pk)
        part = orphans.select(
            F.lit(f"{child}_{parent}").alias("relation"), F.col(fk).alias("fk"), "rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "trace_back",
    f"""
    with fact as ({LINE_FACT_SQL}),
    top as (select line_sk, l_quantity from fact where l_quantity = 50 and l_extendedprice > 100000)
    select t.line_sk, t.l_quantity, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
           o.o_custkey, o.o_orderstatus
    from top t
    left join lineitem l
        on {key_sql('l.l_orderkey', 'l.l_linenumber', 'l.l_partkey', 'l.l_suppkey')} = t.line_sk
    left join orders o on o.o_orderkey = l.l_orderkey
    """,
)
def trace_back(spark, sf_dir):
    """The largest order lines of the fact, followed back to the raw line and its order."""
    start = line_fact(spark, sf_dir).where("l_quantity = 50 and l_extendedprice > 100000").select("line_sk", "l_quantity")
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return reconcile.trace_back(
        start,
        [
            reconcile.Layer("lineitem", lines, surrogate_key(*GRAIN), "line_sk", GRAIN),
            reconcile.Layer(
                "orders", orders, F.col("o_orderkey"), "l_orderkey", ["o_custkey", "o_orderstatus"]
            ),
        ],
    )


@query(
    "trace_indexed",
    f"""
    with fact as ({LINE_FACT_SQL}),
    top as (select line_sk, l_quantity from fact where l_quantity = 50 and l_extendedprice > 100000)
    select t.line_sk, t.l_quantity, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
           o.o_custkey, o.o_orderstatus
    from top t
    left join lineitem l
        on {key_sql('l.l_orderkey', 'l.l_linenumber', 'l.l_partkey', 'l.l_suppkey')} = t.line_sk
    left join orders o on o.o_orderkey = l.l_orderkey
    """,
)
def trace_indexed(spark, sf_dir):
    """The same trace over stored layers laid out by order: an index names the files that hold the keys of a hop."""
    from conform.plans.storage import new_lake
    from conform.sources.lake import file_count

    lake = new_lake(spark, "traced")
    start = line_fact(spark, sf_dir).where("l_quantity = 50 and l_extendedprice > 100000").select("line_sk", "l_quantity")
    layers = [
        trace_index.IndexedLayer("lineitem", lake.silver("lineitem"), surrogate_key(*GRAIN), "line_sk", GRAIN),
        trace_index.IndexedLayer("orders", lake.silver("orders"), F.col("o_orderkey"), "l_orderkey", ["o_custkey", "o_orderstatus"]),
    ]
    for layer, cluster in zip(layers, ("l_orderkey", "o_orderkey"), strict=True):
        rows = table(spark, sf_dir, layer.name)
        lake.write_clustered(rows, layer.path, [cluster], files=file_count(rows, 16))
        trace_index.write_index(spark, layer)
    return trace_index.trace_indexed(start, layers)


@query(
    "trace_back_fanout",
    """
    select c.c_custkey, o.o_orderkey, l.l_linenumber, l.l_quantity
    from customer c left join orders o on o.o_custkey = c.c_custkey
    left join lineitem l on l.l_orderkey = o.o_orderkey where c.c_acctbal > 9000
    """,
)
def trace_back_fanout(spark, sf_dir):
    """From customers to their orders and on to the lines: each hop has many rows for one above."""
    start = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select("c_custkey")
    layers = [
        reconcile.Layer("orders", table(spark, sf_dir, "orders"), F.col("o_custkey"), "c_custkey", ["o_orderkey"]),
        reconcile.Layer(
            "lineitem", table(spark, sf_dir, "lineitem"), F.col("l_orderkey"), "o_orderkey", ["l_linenumber", "l_quantity"]
        ),
    ]
    return reconcile.trace_back(start, layers)


@query(
    "deduped_fact",
    f"""
    select {key_sql('l_orderkey', 'l_linenumber')} as line_sk,
           cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_sk, dayname(l_shipdate) as weekday_name,
           l_quantity, l_extendedprice
    from ({LINE_DEDUPED})
    """,
)
def deduped_fact(spark, sf_dir):
    """Flagship: dedupe, hash key, calendar lookup."""
    lines = table(spark, sf_dir, "lineitem")
    latest = dedupe_latest(lines, LINE_KEYS, LINE_ORDER).withColumn("ship_date", F.to_date("l_shipdate"))
    days = history.date_dim_covering(lines, "l_shipdate")
    take = {"date_sk": "date_sk", "weekday_name": "weekday_name"}
    return star.build_fact(
        latest,
        "line_sk",
        LINE_KEYS,
        [Lookup(days, {"ship_date": "full_date"}, take, size="fixed")],
        ["l_quantity", "l_extendedprice"],
    )
