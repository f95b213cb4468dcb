"""Queries that write and read back: dates, snapshots, publish, clustering, text formats.

Each works in a new folder under the shared scratch folder of the session.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators import curve, profiles, quality as q
from conform.operators.history import scd1_dim
from conform.plans import histories
from conform.plans.registry import key_sql, query, table
from conform.session import scratch_dir
from conform.sources import readers
from conform.sources.lake import Lake, PublishError, file_count


def new_lake(spark, purpose):
    return Lake(spark, scratch_dir(spark, purpose))


@query(
    "latest_partition",
    """
    select event_id, event_type, cast(ts as date) as load_date from events
    where cast(ts as date) = (select max(cast(ts as date)) from events)
    """,
)
def latest_partition(spark, sf_dir):
    """Events stored by day; only the newest day is read."""
    lake = new_lake(spark, "latest")
    path = lake.bronze("stream", "events")
    day = F.to_date("ts")
    lake.write_dates(table(spark, sf_dir, "events"), path, day)
    return lake.read_latest(path).select("event_id", "event_type", "load_date")


@query(
    "backfill_date",
    """
    select event_id, cast(ts as date) as load_date,
           case when cast(ts as date) = (select min(cast(ts as date)) from events)
                then value * 2 else value end as value
    from events
    """,
)
def backfill_date(spark, sf_dir):
    """One day is corrected and written again, twice; the other days stay as they were."""
    lake = new_lake(spark, "backfill")
    path = lake.bronze("stream", "events")
    events = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    lake.write_dates(events, path, "day")
    first = lake.dates(path)[0]
    corrected = events.where(F.col("day") == F.lit(first).cast("date")).withColumn(
        "value", F.col("value") * 2
    )
    for _ in range(2):
        lake.write_date(corrected, path, first)
    return spark.read.parquet(path).select("event_id", "load_date", "value")


SEGMENTS_SQL = """
    select c_mktsegment, count(*) as customers from customer
    where c_acctbal >= 0 group by c_mktsegment
"""


@query(
    "publish_rollback",
    f"""
    select 'first' as moment, * from ({SEGMENTS_SQL})
    union all
    select 'second', c_mktsegment, count(*) from customer group by c_mktsegment
    union all
    select 'rolled_back', * from ({SEGMENTS_SQL})
    """,
)
def publish_rollback(spark, sf_dir):
    """Two runs published in turn, then the first published again."""
    lake = new_lake(spark, "publish")
    customer = table(spark, sf_dir, "customer")
    for run_id, rows in (("r1", customer.where("c_acctbal >= 0")), ("r2", customer)):
        by_segment = rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
        lake.write_model(by_segment, lake.gold(run_id, "segments"))
    out = None
    for moment, run_id in (("first", "r1"), ("second", "r2"), ("rolled_back", "r1")):
        lake.publish(run_id, ["segments"])
        seen = lake.read_current("segments").withColumn("moment", F.lit(moment))
        out = seen if out is None else out.unionByName(seen)
    return out


@query(
    "clustered_write",
    """
    select o_orderkey, o_custkey, cast(extract(year from o_orderdate) as integer) as year,
           o_orderpriority from orders
    """,
)
def clustered_write(spark, sf_dir):
    """Orders in year folders, sorted by priority within files, read back whole."""
    lake = new_lake(spark, "clustered")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority"
    )
    return lake.write_clustered(
        orders,
        lake.gold("r1", "orders"),
        ["o_orderpriority"],
        tiebreak=["o_orderkey"],
        partitions=["year"],
    )


@query(
    "clustered_by_key",
    "select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem where l_partkey between 100 and 120",
)
def clustered_by_key(spark, sf_dir):
    """Lines clustered by part: a filter on the part opens few files and row groups."""
    lake = new_lake(spark, "bykey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    stored = lake.write_clustered(lines, lake.gold("r1", "lines"), ["l_partkey"])
    return stored.where(F.col("l_partkey").between(100, 120))


@query("snapshot_store", f"{histories.FEEDS_SQL} select * from hist2")
def snapshot_store(spark, sf_dir):
    """History kept in storage over three runs; the third brings the second feed again."""
    lake = new_lake(spark, "snapshot")
    feeds = [
        (histories.feed1(spark, sf_dir), histories.DAY1),
        (histories.feed2(spark, sf_dir), histories.DAY2),
        (histories.feed2(spark, sf_dir), histories.DAY3),
    ]
    for feed, ts in feeds:
        kept = lake.update_snapshot("customers", feed, histories.KEYS, histories.CHECKED, ts)
    return kept


BRONZE_COLUMNS = "timestamp '2024-01-01 00:00:00' as load_ts"


@query(
    "bronze_csv_text",
    f"select doc_id, text, lang, {BRONZE_COLUMNS}, true as has_file, date '2024-01-01' as load_date from documents",
)
def bronze_csv_text(spark, sf_dir):
    """Free text with commas, quotes and line breaks, landed as CSV and loaded to a dated table."""
    lake = new_lake(spark, "csv")
    landing = f"{lake.root}/landing/documents"
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    (
        documents.write.option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(landing)
    )
    feed = readers.read_csv(spark, landing, documents.schema, free_text=True)
    loaded = readers.with_load_columns(feed, "2024-01-01 00:00:00")
    path = lake.bronze("docs", "documents")
    lake.write_date(loaded, path, "2024-01-01")
    stored = lake.read_date(path, "2024-01-01")
    return stored.select(
        "doc_id", "text", "lang", "load_ts",
        F.col("source_file").endswith(".csv").alias("has_file"), "load_date",
    )


@query(
    "bronze_csv_dates",
    "select o_orderkey, cast(o_orderdate as date) as o_orderdate, o_totalprice from orders",
)
def bronze_csv_dates(spark, sf_dir):
    """Plain CSV with month-first dates and an explicit schema."""
    lake = new_lake(spark, "csvdates")
    landing = f"{lake.root}/landing/orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )
    orders.write.option("header", True).option("dateFormat", "M/d/yyyy").csv(landing)
    return readers.read_csv(spark, landing, orders.schema, date_format="M/d/yyyy")


@query(
    "bronze_json",
    """
    select user_id, array_to_string(list_sort(list(distinct event_type)), '; ') as event_types
    from events group by user_id
    """,
)
def bronze_json(spark, sf_dir):
    """Nested rows landed as JSON lines and read back nested, then flattened."""
    lake = new_lake(spark, "json")
    landing = f"{lake.root}/landing/users"
    users = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set("event_type")).alias("event_types"))
    )
    users.write.json(landing)
    feed = readers.read_json_lines(spark, landing, "user_id bigint, event_types array<string>")
    return feed.select("user_id", F.array_join("event_types", "; ").alias("event_types"))


@query(
    "external_view",
    f"select {key_sql('o_orderpriority')} as priority_sk, o_orderpriority from "
    "(select distinct o_orderpriority from orders)",
)
def external_view(spark, sf_dir):
    """A published model read by name, as an external reader would."""
    lake = new_lake(spark, "view")
    dim = scd1_dim(table(spark, sf_dir, "orders"), ["o_orderpriority"], "priority_sk")
    lake.write_model(dim, lake.gold("r1", "priority"))
    lake.publish("r1", ["priority"])
    (name,) = lake.register_current(prefix="published_")
    return spark.table(name)


@query(
    "rewrite_clustered",
    """
    select o_orderkey, cast(extract(year from o_orderdate) as integer) as year from orders
    where extract(year from o_orderdate) > (select min(extract(year from o_orderdate)) from orders)
    """,
)
def rewrite_clustered(spark, sf_dir):
    """A table in year folders written again without its first year: that folder goes."""
    lake = new_lake(spark, "rewrite")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    path = lake.silver("orders")
    full = lake.write_clustered(orders, path, ["o_orderkey"], partitions=["year"])
    later = orders.where(F.col("year") > full.agg(F.min("year")).scalar())
    lake.write_clustered(later, path, ["o_orderkey"], partitions=["year"])
    return spark.read.parquet(path)


@query(
    "backfill_empty",
    """
    select event_id, cast(ts as date) as load_date from events
    where cast(ts as date) > (select min(cast(ts as date)) from events)
    """,
)
def backfill_empty(spark, sf_dir):
    """A date whose corrected feed has no rows is empty afterwards; the other dates stay."""
    lake = new_lake(spark, "emptied")
    path = lake.bronze("stream", "events")
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    lake.write_dates(events, path, "day")
    lake.write_date(events.where("event_id is null"), path, lake.dates(path)[0])
    return spark.read.parquet(path).select("event_id", "load_date")


@query("publish_immutable", SEGMENTS_SQL)
def publish_immutable(spark, sf_dir):
    """A published run refuses to be written again, so readers keep what was published."""
    lake = new_lake(spark, "immutable")
    customer = table(spark, sf_dir, "customer")
    count = lambda df: df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    lake.write_model(count(customer.where("c_acctbal >= 0")), lake.gold("r1", "segments"))
    lake.publish("r1", ["segments"])
    try:
        lake.write_model(count(customer), lake.gold("r1", "segments"))
    except PublishError:
        return lake.read_current("segments")
    raise AssertionError("a published run was changed")


DOCUMENT_ROWS = 2_000  # of one JSON document, which is read as a whole


@query("bronze_json_array", "select o_orderkey, o_custkey, o_orderpriority from orders")
def bronze_json_array(spark, sf_dir):
    """The orders landed as many JSON documents, each wrapping some as ``results``, and read back as rows in parallel."""
    landing = f"{new_lake(spark, 'jsonarray').root}/landing/orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    documents = -(-orders.count() // DOCUMENT_ROWS)
    group = F.pmod(F.xxhash64("o_orderkey"), F.lit(max(1, documents)))
    rows = F.array_join(F.collect_list(F.to_json(F.struct(*orders.columns))), ",")  # about DOCUMENT_ROWS, whatever the table
    wrapped = orders.groupBy(group.alias("g")).agg(F.concat(F.lit('{"results": ['), rows, F.lit("]}")).alias("value"))
    wrapped.select("value").write.option("maxRecordsPerFile", 1).text(landing)
    return readers.read_json_array(spark, landing, orders.schema)


@query(
    "bronze_contract",
    """
    with feed as (
        select count(*) as n from customer where c_acctbal >= 0)
    select 'whole' as feed, n as loaded, '' as refused from feed
    union all
    select 'broken', 0, 'blocked by: drug_reviews.usefulCount is missing, drug_reviews.helpful is extra'
    """,
)
def bronze_contract(spark, sf_dir):
    """A feed loaded by date; one whose header broke the contract is refused and leaves the date as it was."""
    from conform.plans import mart

    lake = new_lake(spark, "contract")
    customer = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    feed = customer.select(
        F.col("c_custkey").alias("uniqueID"), F.col("c_name").alias("drugName"), F.col("c_mktsegment").alias("condition"),
        F.lit("text").alias("review"), F.lit(5).alias("rating"), F.lit("1-Jan-20").alias("date"), F.lit(0).alias("usefulCount"),
    )
    outcomes = []
    for name, rows in (("whole", feed), ("broken", feed.withColumnRenamed("usefulCount", "helpful"))):
        landing = f"{lake.root}/landing/{name}"
        rows.write.option("header", True).csv(landing)
        try:
            outcomes.append((name, mart.load_bronze(lake, "drug_reviews", landing, "2024-01-01", "2024-01-01 06:00:00"), ""))
        except q.QualityGateError as e:
            outcomes.append((name, 0, str(e)))
    kept = mart.bronze(lake, "drug_reviews", "2024-01-01").agg(F.count(F.lit(1)).alias("kept"))
    rows = spark.createDataFrame(outcomes, "feed string, loaded long, refused string")
    return rows.withColumn("loaded", F.when(F.col("loaded") > 0, kept.scalar()).otherwise(F.col("loaded")))


@query(
    "release_freshness",
    """
    with ages as (
        select 'events' as source, date_diff('second', max(ts), timestamp '2024-02-15 00:00:00') / 86400.0 as age from events
        union all
        select 'orders', date_diff('second', cast(max(o_orderdate) as timestamp), timestamp '2024-02-15 00:00:00') / 86400.0 from orders)
    select 'freshness_' || source as "check", case when age > 30 and age <= 10000 then 'warn' else 'error' end as severity,
           case when age > 30 then 1 else 0 end as failing, 1 as total, age <= 30 as passed
    from ages
    """,
)
def release_freshness(spark, sf_dir):
    """The age of sources at a release, against a limit that warns and one that blocks."""
    sources = {"events": (table(spark, sf_dir, "events"), "ts"), "orders": (table(spark, sf_dir, "orders"), "o_orderdate")}
    return q.fresh_enough(q.freshness(sources), "2024-02-15 00:00:00", 30, 10_000).drop("observed")


@query(
    "external_table",
    "select o_orderpriority, count(*) as orders from orders group by o_orderpriority",
)
def external_table(spark, sf_dir):
    """A published model read as an external table of the catalogue, which a reader can not change by dropping it."""
    lake = new_lake(spark, "external")
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    lake.write_model(counts, lake.gold("r1", "priorities"))
    lake.publish("r1", ["priorities"])
    (name,) = lake.register_current(prefix="external_", tables=True)
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise AssertionError("a reader could delete the model")
    spark.sql(f"drop table {name}")
    lake.register_current(prefix="external_", tables=True)  # the files are there still
    return spark.table(name)


@query(
    "clustered_curve",
    """
    with cuts as (
        select quantile_disc(l_partkey, 0.5) as part, quantile_disc(l_suppkey, 0.5) as supp from lineitem)
    select 'part' as filtered, count(*) as rows, cast(sum(l_linenumber) as bigint) as lines, true as skips
    from lineitem, cuts where l_partkey = part
    union all
    select 'supplier', count(*), cast(sum(l_linenumber) as bigint), true from lineitem, cuts where l_suppkey = supp
    """,
)
def clustered_curve(spark, sf_dir):
    """Lines clustered by part and supplier alike: a filter on either alone opens under half of the files."""
    lake = new_lake(spark, "curve")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    stored = lake.write_on_curve(lines, lake.gold("r1", "lines"), ["l_partkey", "l_suppkey"], files=file_count(lines, 16))
    middle = lines.agg(F.expr("percentile_disc(0.5) within group (order by l_partkey) as part"), F.expr("percentile_disc(0.5) within group (order by l_suppkey) as supp")).first()
    files = curve.spans(stored, ["l_partkey", "l_suppkey"])
    out = None
    for name, column, value in (("part", "l_partkey", middle["part"]), ("supplier", "l_suppkey", middle["supp"])):
        opened = F.count_if((F.col(f"lo_{column}") <= value) & (F.col(f"hi_{column}") >= value)) * 2 < F.count(F.lit(1))
        found = stored.where(F.col(column) == value).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_linenumber").cast("long").alias("lines"))
        row = found.select(F.lit(name).alias("filtered"), "rows", "lines", files.agg(opened.alias("skips")).scalar().alias("skips"))
        out = row if out is None else out.unionByName(row)
    return out


PROFILED = ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(
    "profile_range",
    " union all ".join(
        f"""
        select '{c}' as "column", count(*) as rows, count(*) filter ({c} is null) as nulls,
               {f"cast(min({c}) as double)" if n else "cast(null as double)"} as lowest,
               {f"cast(max({c}) as double)" if n else "cast(null as double)"} as highest,
               true as distinct_ok, true as quantiles_ok, true as frequent_ok
        from lineitem where cast(l_shipdate as date) between date '1995-01-01' and date '1996-06-30'
        """
        for c, n in (("l_partkey", True), ("l_quantity", True), ("l_extendedprice", True), ("l_returnflag", False))
    ),
)
def profile_range(spark, sf_dir):
    """A year and a half of lines profiled from stored sketches, a row a column and day, and held against the lines themselves."""
    lake = new_lake(spark, "profiles")
    lines = table(spark, sf_dir, "lineitem")
    stored = lake.write_model(profiles.daily_profile(lines, "l_shipdate", PROFILED), lake.silver("profiles"))
    merged = profiles.merged_profile(stored, "1995-01-01", "1996-06-30")
    inside = lines.where(F.to_date("l_shipdate").between("1995-01-01", "1996-06-30"))
    return profiles.within_bounds(merged, inside)


@query(
    "seed_csv",
    """
    select c.c_custkey, r.r_name from customer c
    join nation n on n.n_nationkey = c.c_nationkey join region r on r.r_regionkey = n.n_regionkey
    """,
)
def seed_csv(spark, sf_dir):
    """A seed kept as CSV with an explicit schema, looked up by a large table."""
    path = f"{new_lake(spark, 'seed').root}/seeds/nations"
    seed = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    seed.write.option("header", True).csv(path)
    stored = readers.read_csv(spark, path, seed.schema)
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return customers.join(stored, "n_nationkey").select("c_custkey", "r_name")


@query(
    "first_run_state",
    "select o_orderstatus, 0 as rows_before, count(*) as rows_now from orders group by o_orderstatus",
)
def first_run_state(spark, sf_dir):
    """A first run finds no prior state and takes it as empty."""
    path = new_lake(spark, "prior").silver("orders")
    now = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows_now"))
    before = readers.read_or_empty(spark, path, now.withColumnRenamed("rows_now", "n").schema)
    return now.join(before, "o_orderstatus", "left").select(
        "o_orderstatus", F.coalesce("n", F.lit(0)).cast("int").alias("rows_before"), "rows_now"
    )


@query(
    "stored_checks",
    """
    select 'r1' as run_id, 'lines' as model, 'accepted_range_l_quantity' as "check",
           count(*) filter (l_quantity > 40) as failing, count(*) as total,
           count(*) filter (l_quantity > 40) = 0 as passed from lineitem
    union all
    select 'r1', 'lines', 'not_null_l_partkey', count(*) filter (l_partkey is null), count(*),
           count(*) filter (l_partkey is null) = 0 from lineitem
    """,
)
def stored_checks(spark, sf_dir):
    """Check results kept under their run and model; a rerun replaces its own."""
    lake = new_lake(spark, "results")
    lines = table(spark, sf_dir, "lineitem")
    results = q.run_checks(lines, [q.accepted_range("l_quantity", high=40), q.not_null("l_partkey")])
    for _ in range(2):
        lake.append_quality(results, "r1", "lines")
    return lake.read_quality("r1").select(F.lit("r1").alias("run_id"), "model", "check", "failing", "total", "passed")


@query(
    "quality_gate",
    """
    select 'empty' as run, 'orders of run empty is empty' as refused, 'good' as current
    where (select count(*) from orders where o_totalprice < 0) = 0
    union all
    select 'failed_check', 'blocked by: accepted_values_o_orderstatus', 'good'
    where (select count(*) from orders where o_orderstatus not in ('F', 'O')) > 0
    """,
)
def quality_gate(spark, sf_dir):
    """A run with an empty model and a run with a failed check: neither may be published."""
    lake = new_lake(spark, "gate")
    orders = table(spark, sf_dir, "orders")
    lake.write_model(orders, lake.gold("good", "orders"))
    lake.publish("good", ["orders"])
    lake.write_model(orders.where("o_totalprice < 0"), lake.gold("empty", "orders"))
    outcomes = []
    try:
        lake.publish("empty", ["orders"])
    except PublishError as e:
        outcomes.append(("empty", str(e), lake.current_run()))
    try:
        q.gate(q.run_checks(orders, [q.accepted_values("o_orderstatus", ["F", "O"])]))
    except q.QualityGateError as e:
        outcomes.append(("failed_check", str(e), lake.current_run()))
    return spark.createDataFrame(outcomes, "run string, refused string, current string")
