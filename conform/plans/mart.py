"""The pharma mart: three feeds that share no key, one conformed star, two serving tables.

Feeds: daily sales by drug category (CSV, wide), a product master (JSON, nested) and
drug reviews (CSV, free text). Stages meet at stored Parquet, so each can be rerun alone.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import dates, text
from conform.operators import history, joins, match, quality as q, reconcile, reshape, star
from conform.operators.match import Seed
from conform.operators.star import Lookup, Members
from conform.plans import fixed
from conform.session import sized
from conform.sources import readers
from conform.sources.lake import Lake

# fixed values: names, types and order of the feeds' columns
_SALES_VALUES = (
    ", ".join(f"{code} double" for code in fixed.ATC_CODES)
    + ", Year bigint, Month bigint, Hour bigint, `Weekday Name` string"
)
SALES_SCHEMA = f"datum date, {_SALES_VALUES}"
HOURLY_SCHEMA = f"datum timestamp, {_SALES_VALUES}"
NDC_SCHEMA = (
    "product_ndc string, generic_name string, brand_name string, pharm_class array<string>, "
    "route array<string>, dosage_form string, labeler_name string, "
    "marketing_start_date string, marketing_end_date string"
)
REVIEW_SCHEMA = (
    "uniqueID bigint, drugName string, condition string, review string, rating bigint, "
    "date string, usefulCount bigint"
)

SNAPSHOT = "snap_beta_ndc"
FRESH_DAYS = (1.5, 2.0)  # age of a feed at the snapshot time that warns, and that blocks a release
# fixed values: names and order of the feeds' and models' columns
NDC_KEY = ["product_ndc"]
NDC_CHECKED = [
    "generic_name", "proprietary_name", "pharm_class", "route",
    "dosage_form", "labeler_name", "marketing_start_date", "marketing_end_date",
]
STAR = ("dim_date", "dim_condition", "dim_drug", "fact_sales", "fact_review")
SERVING = ("obt_sales_wide", "obt_review_wide")
GOLD = (*STAR, *SERVING)
STAR_KEYS = {
    "dim_date": "date_sk",
    "dim_condition": "condition_sk",
    "dim_drug": "drug_sk",
    "fact_sales": "sales_sk",
    "fact_review": "review_sk",
}
DRUG_MEMBERS = Members(
    key="drug_sk",
    member_type="drug_member_type",
    detail="ndc_product",
    category="atc_category",
    natural_key="product_ndc",
    code="atc_code",
    attributes=(
        "generic_name", "proprietary_name", "pharm_class", "dosage_form", "route", "labeler_name",
    ),
    category_attributes={"generic_name": "example_generic", "pharm_class": "pharm_class_hint"},
)


# --- bronze -------------------------------------------------------------------------------


def read_feed(spark: SparkSession, table: str, files: str | list[str]) -> DataFrame:
    """One landed feed with its contract schema."""
    if table == "sales_daily":
        return readers.read_csv(spark, files, SALES_SCHEMA, date_format="M/d/yyyy")
    if table == "sales_hourly":
        return readers.read_csv(spark, files, HOURLY_SCHEMA, timestamp_format="M/d/yyyy H:mm")
    if table == "ndc_directory":
        return readers.read_json_array(spark, files, NDC_SCHEMA)
    if table == "drug_reviews":
        return readers.read_csv(spark, files, REVIEW_SCHEMA, free_text=True)
    raise ValueError(f"unknown feed {table!r}")


CSV_SCHEMAS = {"sales_daily": SALES_SCHEMA, "sales_hourly": HOURLY_SCHEMA, "drug_reviews": REVIEW_SCHEMA}
# fixed values: the source that each feed comes from
BRONZE_SOURCE = {
    "sales_daily": "alpha",
    "sales_hourly": "alpha",
    "ndc_directory": "beta",
    "drug_reviews": "gamma",
}


def load_bronze(
    lake: Lake,
    table: str,
    files: str | list[str],
    load_date: str | dt.date,
    load_ts: str | dt.datetime,
) -> int:
    """Land one feed as one date of its Bronze table and count what can be read back.

    One job per feed, so a late or broken feed does not hold up the others. An empty
    feed is refused: it would wipe the date. So is a CSV feed whose header is not the contract's, with the columns named, before a row is read.
    """
    if table in CSV_SCHEMAS:
        header = lake.spark.createDataFrame([], readers.csv_header(lake.spark, files))
        problems = q.contract_check(header, CSV_SCHEMAS[table], table, types=False).collect()
        if problems:
            raise q.QualityGateError([f"{table}.{r['column']} is {r['problem']}" for r in problems])
    feed = readers.with_load_columns(read_feed(lake.spark, table, files), load_ts)
    if feed.isEmpty():
        raise q.QualityGateError([f"{table} has no rows"])
    path = lake.bronze(BRONZE_SOURCE[table], table)
    lake.write_date(feed, path, load_date)
    return lake.read_date(path, load_date).count()


def bronze(lake: Lake, table: str, load_date: str | dt.date) -> DataFrame:
    path = lake.bronze(BRONZE_SOURCE[table], table)
    return lake.read_date(path, load_date).drop("load_date")


# --- silver -------------------------------------------------------------------------------


def silver_sales(raw: DataFrame) -> DataFrame:
    """One row per day and category; negative units are reporting errors and become 0."""
    ids = {"sale_date": F.col("datum"), "load_ts": F.col("load_ts"), "source_file": F.col("source_file")}
    base = raw.select(*[c.alias(n) for n, c in ids.items()], *fixed.ATC_CODES)
    long = reshape.unpivot_clamp(base, list(ids), fixed.ATC_CODES, "atc_code", "units_sold")
    return long.select("sale_date", "atc_code", "units_sold", "load_ts", "source_file")


def silver_ndc(raw: DataFrame) -> DataFrame:
    """One row per product, the one marketed last, with arrays as text and dates parsed."""
    kept = raw.where(F.col("product_ndc").isNotNull()).withColumnRenamed(
        "brand_name", "proprietary_name"
    )
    order = [
        ("marketing_start_date", "desc"), ("marketing_end_date", "desc"), ("labeler_name", "asc"),
        ("dosage_form", "asc"), ("proprietary_name", "asc"), ("generic_name", "asc"),
        ("pharm_class", "asc"), ("route", "asc"), ("load_ts", "desc"), ("source_file", "asc"),
    ]
    latest = reshape.dedupe_latest(kept, NDC_KEY, order)
    flat = reshape.flatten(latest, joins=["pharm_class"], firsts=["route"])
    parsed = flat.withColumns(
        {c: dates.parse_compact(c) for c in ("marketing_start_date", "marketing_end_date")}
    )
    return parsed.select(
        "product_ndc", "generic_name", "proprietary_name", "pharm_class", "route", "dosage_form",
        "labeler_name", "marketing_start_date", "marketing_end_date", "load_ts", "source_file",
    )


def silver_reviews(raw: DataFrame) -> DataFrame:
    """Reviews with a normalised drug name; a condition holding an HTML tag is nulled and flagged."""
    named = raw.where(F.col("drugName").isNotNull()).withColumnRenamed("condition", "condition_name")
    scrubbed = reshape.scrub_and_flag(named, "condition_name", text.HTML_TAG, fixed.SCRUB_REASON)
    return scrubbed.select(
        F.col("uniqueID").alias("review_id"),
        F.col("drugName").alias("drug_name_raw"),
        text.normalise("drugName").alias("drug_name_norm"),
        "condition_name",
        "dq_flag",
        "dq_reason",
        "rating",
        F.col("usefulCount").alias("useful_count"),
        dates.parse_day_mon_yy("date").alias("review_date"),
        "load_ts",
        "source_file",
    )


def atc_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The category seed: built in, or a maintained CSV with the same columns."""
    if path:
        return readers.read_csv(spark, path, fixed.ATC_SEED_SCHEMA)
    return spark.createDataFrame(fixed.ATC_SEED, fixed.ATC_SEED_SCHEMA)


# --- crosswalk, star, serving -----------------------------------------------------------------


def drug_crosswalk(ndc: DataFrame, seed: DataFrame) -> DataFrame:
    return match.tiered_match(
        ndc, Seed(seed, "atc_code", "pharm_class_hint", "example_generic"),
        NDC_KEY, "generic_name", "pharm_class",
    )


def dim_date(spark: SparkSession) -> DataFrame:
    return history.date_dim(spark, *fixed.CALENDAR)


def dim_condition(reviews: DataFrame) -> DataFrame:
    return history.scd1_dim(reviews, ["condition_name"], "condition_sk")


def dim_drug(snapshot: DataFrame, crosswalk: DataFrame, seed: DataFrame) -> DataFrame:
    return star.conformed_dim(snapshot, crosswalk, seed, DRUG_MEMBERS)


def category_members(drugs: DataFrame) -> DataFrame:
    """The few category rows of a large dimension, with their real size."""
    rows = drugs.where(F.col("drug_member_type") == "atc_category")
    return sized(rows.select("drug_sk", "atc_code", "generic_name", "pharm_class"), "categories")


def fact_sales(sales: DataFrame, days: DataFrame, drugs: DataFrame) -> DataFrame:
    """One row per day and category, keyed to the category member."""
    return star.build_fact(
        sales,
        "sales_sk",
        ["sale_date", "atc_code"],
        [
            Lookup(days, {"sale_date": "full_date"}, {"date_sk": "date_sk"}, size="fixed"),
            Lookup(category_members(drugs), {"atc_code": "atc_code"}, {"drug_sk": "drug_sk"}),
        ],
        ["units_sold", "load_ts", "source_file"],
    )


def fact_review(
    reviews: DataFrame, days: DataFrame, drugs: DataFrame, conditions: DataFrame
) -> DataFrame:
    """One row per review; drug and condition stay NULL where nothing matches."""
    current = drugs.where((F.col("drug_member_type") == "ndc_product") & F.col("is_current"))
    by_name = joins.name_map(current, "drug_sk", ["generic_name", "proprietary_name"])
    by_name = sized(by_name, "names")
    return star.build_fact(
        reviews,
        "review_sk",
        ["review_id"],
        [
            Lookup(days, {"review_date": "full_date"}, {"date_sk": "date_sk"}, size="fixed"),
            Lookup(by_name, {"drug_name_norm": "name_norm"}, {"drug_sk": "drug_sk"}),
            Lookup(conditions, {"condition_name": "condition_name"}, {"condition_sk": "condition_sk"}),
        ],
        ["rating", "useful_count", "dq_flag", "dq_reason", "load_ts", "source_file"],
    )


def obt_sales_wide(facts: DataFrame, days: DataFrame, drugs: DataFrame) -> DataFrame:
    day = {"full_date": "sale_date", "year": "year", "month": "month", "weekday_name": "weekday_name"}
    drug = {c: c for c in ("atc_code", "generic_name", "pharm_class")}
    return star.serve(
        facts,
        ["sales_sk", "units_sold"],
        [
            Lookup(days, {"date_sk": "date_sk"}, day, "inner", "fixed"),
            Lookup(category_members(drugs), {"drug_sk": "drug_sk"}, drug, "inner"),
        ],
    )


def obt_review_wide(
    facts: DataFrame, days: DataFrame, drugs: DataFrame, conditions: DataFrame
) -> DataFrame:
    """The date must resolve; drug and condition may not."""
    day = {"full_date": "review_date", "year": "year", "month": "month"}
    drug = {c: c for c in ("generic_name", "proprietary_name", "atc_code")}
    return star.serve(
        facts,
        ["review_sk", "rating", "useful_count"],
        [
            Lookup(days, {"date_sk": "date_sk"}, day, "inner", "fixed"),
            Lookup(conditions, {"condition_sk": "condition_sk"}, {"condition_name": "condition_name"}),
            Lookup(drugs, {"drug_sk": "drug_sk"}, drug),
        ],
    )


# --- checks -------------------------------------------------------------------------------


def model_checks(t: dict[str, DataFrame]) -> dict[str, list[q.Check]]:
    """The checks of each model, by model name."""
    ndc_only = "drug_member_type = 'ndc_product'"
    tiers = [*match.TIERS, match.UNMATCHED]
    return {
        "atc_pharmclass_crosswalk": [q.not_null("atc_code"), q.unique("atc_code")],
        "stg_alpha__sales": [
            q.not_null("sale_date"), q.not_null("atc_code"),
            q.accepted_values("atc_code", fixed.ATC_CODES),
            q.not_null("units_sold"), q.accepted_range("units_sold", low=0),
        ],
        "stg_beta__ndc": [
            q.not_null("product_ndc"), q.unique("product_ndc"),
            # A few products carry a brand name only: true of the source, not a defect.
            q.not_null("generic_name", severity=q.WARN),
        ],
        "stg_gamma__reviews": [
            q.not_null("review_id"), q.unique("review_id"), q.not_null("drug_name_raw"),
            q.not_null("dq_flag"), q.not_null("dq_reason", where="dq_flag"),
            q.not_null("rating"), q.accepted_range("rating", *fixed.RATING),
        ],
        "dim_date": [
            q.not_null("date_sk"), q.unique("date_sk"), q.not_null("full_date"), q.unique("full_date"),
        ],
        "dim_condition": [
            q.not_null("condition_sk"), q.unique("condition_sk"),
            q.not_null("condition_name"), q.unique("condition_name"),
        ],
        "dim_drug": [
            q.not_null("drug_sk"), q.unique("drug_sk"), q.not_null("drug_member_type"),
            q.accepted_values("drug_member_type", ["ndc_product", "atc_category"]),
            q.not_null("match_confidence", where=ndc_only),
            q.accepted_values("match_confidence", tiers, where=ndc_only),
            q.not_null("is_combination_product"),
        ],
        "fact_sales": [
            q.not_null("sales_sk"), q.unique("sales_sk"),
            q.not_null("date_sk"), q.relationships("date_sk", t["dim_date"], "date_sk"),
            q.not_null("drug_sk"), q.relationships("drug_sk", t["dim_drug"], "drug_sk"),
            q.not_null("units_sold"), q.accepted_range("units_sold", low=0),
        ],
        "fact_review": [
            q.not_null("review_sk"), q.unique("review_sk"),
            q.not_null("date_sk"), q.relationships("date_sk", t["dim_date"], "date_sk"),
            q.relationships("drug_sk", t["dim_drug"], "drug_sk"),
            q.relationships("condition_sk", t["dim_condition"], "condition_sk"),
            q.not_null("rating"), q.accepted_range("rating", *fixed.RATING), q.not_null("dq_flag"),
        ],
    }


def suites(
    drug_rows: tuple[int, int | None], sales_rows: int, review_rows: int
) -> dict[str, list[q.Check]]:
    """Release expectations; the row counts are those of the feeds at hand.

    The drug dimension keeps closed versions, so its count is a band that grows.
    """
    return {
        "dim_drug": [
            q.row_count(*drug_rows), q.not_null("drug_sk"), q.unique("drug_sk"),
            q.distinct_in_set("drug_member_type", ["ndc_product", "atc_category"]),
        ],
        "fact_sales": [
            q.row_count(sales_rows, sales_rows),
            q.proportion_not_null("drug_sk", 1.0, 1.0), q.proportion_not_null("date_sk", 1.0, 1.0),
            q.accepted_range("units_sold", low=0),
        ],
        "fact_review": [
            q.row_count(review_rows, review_rows),
            q.proportion_not_null("drug_sk", fixed.NAME_FLOOR, 1.0),
            q.proportion_not_null("condition_sk", fixed.CONDITION_FLOOR, 1.0),
            q.accepted_range("rating", *fixed.RATING), q.not_null("dq_flag"),
        ],
    }


def category_members_match(drugs: DataFrame, seed: DataFrame) -> DataFrame:
    """Singular check: one category member per seed row."""
    members = drugs.where(F.col("drug_member_type") == "atc_category")
    return q.singular("category_members_match_seed", q.same_count(members, seed))


def layer_hops(
    landed: dict[str, DataFrame], t: dict[str, DataFrame], bronze_tables: dict[str, DataFrame]
) -> list[reconcile.Hop]:
    """Nine counts from landing to gold."""
    hops = [reconcile.Hop(f"landing_bronze_{n}", landed[n], bronze_tables[n]) for n in BRONZE_SOURCE]
    return [*hops, *inner_hops(t, bronze_tables)]


def inner_hops(t: dict[str, DataFrame], bronze_tables: dict[str, DataFrame]) -> list[reconcile.Hop]:
    """The counts from Bronze to gold."""
    loss = {"rule": "drop", "tolerance": fixed.DROP_TOLERANCE}
    return [
        reconcile.Hop(
            "bronze_silver_sales", bronze_tables["sales_daily"], t["stg_alpha__sales"],
            factor=len(fixed.ATC_CODES),
        ),
        reconcile.Hop("bronze_silver_ndc", bronze_tables["ndc_directory"], t["stg_beta__ndc"], **loss),
        reconcile.Hop(
            "bronze_silver_reviews", bronze_tables["drug_reviews"], t["stg_gamma__reviews"], **loss
        ),
        reconcile.Hop("silver_gold_sales", t["stg_alpha__sales"], t["fact_sales"]),
        reconcile.Hop("silver_gold_reviews", t["stg_gamma__reviews"], t["fact_review"]),
    ]


# --- the run ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """One build: which Bronze date it reads, where its gold goes, and its snapshot time."""

    lake: Lake
    load_date: str
    run_id: str
    snapshot_ts: str
    seed_path: str | None = None


def build(run: Run) -> dict[str, DataFrame]:
    """Bronze date -> silver, snapshot, star and serving tables of one run id. Does not publish."""
    lake, spark = run.lake, run.lake.spark
    t: dict[str, DataFrame] = {}

    def silver(name: str, df: DataFrame) -> None:
        t[name] = lake.write_model(df, lake.silver(name))

    def gold(name: str, df: DataFrame) -> None:
        t[name] = lake.write_model(df, lake.gold(run.run_id, name))

    seed = t["atc_pharmclass_crosswalk"] = atc_seed(spark, run.seed_path)
    silver("stg_alpha__sales", silver_sales(bronze(lake, "sales_daily", run.load_date)))
    silver("stg_beta__ndc", silver_ndc(bronze(lake, "ndc_directory", run.load_date)))
    silver("stg_gamma__reviews", silver_reviews(bronze(lake, "drug_reviews", run.load_date)))

    snapshot = lake.update_snapshot(
        SNAPSHOT, t["stg_beta__ndc"], NDC_KEY, NDC_CHECKED, run.snapshot_ts
    )
    gold("dim_date", dim_date(spark))
    gold("dim_condition", dim_condition(t["stg_gamma__reviews"]))
    gold("dim_drug", dim_drug(snapshot, drug_crosswalk(t["stg_beta__ndc"], seed), seed))
    days, drugs, conditions = t["dim_date"], t["dim_drug"], t["dim_condition"]
    gold("fact_sales", fact_sales(t["stg_alpha__sales"], days, drugs))
    gold("fact_review", fact_review(t["stg_gamma__reviews"], days, drugs, conditions))

    sales = obt_sales_wide(t["fact_sales"], days, drugs)
    reviews = obt_review_wide(t["fact_review"], days, drugs, conditions)
    for name, df, cluster in (
        ("obt_sales_wide", sales, ["year", "atc_code"]),
        ("obt_review_wide", reviews, ["year"]),
    ):
        t[name] = lake.write_clustered(df, lake.gold(run.run_id, name), cluster)
    return t


def validate(run: Run, t: dict[str, DataFrame]) -> DataFrame:
    """Run and store every check of the built models; gives back all results."""
    for model, checks in model_checks(t).items():
        run.lake.append_quality(q.run_checks(t[model], checks), run.run_id, model)
    extra = category_members_match(t["dim_drug"], t["atc_pharmclass_crosswalk"])
    run.lake.append_quality(extra, run.run_id, "singular")
    return run.lake.read_quality(run.run_id)


def expectations(run: Run, t: dict[str, DataFrame]) -> DataFrame:
    """The release suites and the layer counts of a built run, stored with its check results.

    Row counts come from the silver tables at hand; the drug dimension holds one current row per
    open product of the snapshot and per seed row.
    """
    lake, seed = run.lake, t["atc_pharmclass_crosswalk"]
    silver = {m: t[m].count() for m in ("stg_alpha__sales", "stg_beta__ndc", "stg_gamma__reviews")}
    seed_rows = seed.count()
    asked = suites((silver["stg_beta__ndc"] + seed_rows, None), silver["stg_alpha__sales"], silver["stg_gamma__reviews"])
    for model, checks in asked.items():
        lake.append_quality(q.run_checks(t[model], checks), run.run_id, f"suite_{model}")
    products = lake.read_snapshot(SNAPSHOT).where(F.col(history.TO).isNull())
    members = reconcile.Hop("snapshot_gold_drugs", products, t["dim_drug"].where("is_current"), offset=seed_rows)
    tables = {n: bronze(lake, n, run.load_date) for n in ("sales_daily", "ndc_directory", "drug_reviews")}
    report = reconcile.reconcile_layers([*inner_hops(t, tables), members])
    lake.append_quality(q.singular("layers_reconcile", report.where("not passed")), run.run_id, "layers")
    ages = q.freshness({n: (df, "load_ts") for n, df in tables.items()})
    lake.append_quality(q.fresh_enough(ages, run.snapshot_ts, *FRESH_DAYS), run.run_id, "freshness")
    return lake.read_quality(run.run_id)


def release(run: Run, t: dict[str, DataFrame]) -> dict[str, int]:
    """Check, then publish; a failed error check stops before anything is switched.

    Products that did not match, or only by an unverified rule, are stored for the steward either way.
    """
    quarantined = match.match_exceptions(t["dim_drug"].where("match_confidence is not null"))
    run.lake.write_model(quarantined, run.lake.exceptions(run.run_id))
    validate(run, t)
    q.gate(expectations(run, t))
    return run.lake.publish(run.run_id, GOLD)


def reconcile_copy(run: Run, copy_paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Row counts and key sets of the published star against a second copy of it."""
    return {
        model: reconcile.reconcile_keys(
            run.lake.read_current(model), readers.read_table(run.lake.spark, copy_paths[model], fmt), [key]
        )
        for model, key in STAR_KEYS.items()
    }


def copy_star(lake: Lake, target: str, fmt: str = "parquet") -> dict[str, str]:
    """A second copy of the published star in another table format, clustered by drug key."""
    clustered = {"dim_drug": ["drug_sk"], "fact_sales": ["drug_sk"]}
    paths = {}
    for model in STAR:
        paths[model] = f"{target}/{model}"
        df = lake.read_current(model)
        if model in clustered:
            lake.write_clustered(df, paths[model], clustered[model], fmt=fmt)
        else:
            lake.write_model(df, paths[model], fmt)
    return paths
