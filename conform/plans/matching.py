"""Queries on the crosswalk: tiered match, coverage, exceptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators import match
from conform.operators.match import Seed
from conform.plans.registry import query, table

# A small maintained seed over the vocabulary of the parts: shared hints, an example
# shorter than five letters, a hint that matches nothing.
PART_SEED = [
    ("C01", "Economy", "red widget"),
    ("C02", "Economy", "blue bolt"),
    ("C03", "Promo", "gizmo"),
    ("C04", "no such type", "anvil"),
    ("C05", "no such type", "gear"),
    ("C06", "no such type", "widget"),
    ("C07", "no such type", "small ring"),
    ("C08", "no such type", "plate"),
]
SEED_VALUES = ", ".join(str(r) for r in PART_SEED)

# Parts above size 40 are sold as sets, so their name lists two ingredients.
PRODUCTS_SQL = """
    select p_partkey, case when p_size > 40 then p_name || ' and filler' else p_name end as name,
           p_type || ' [T]' as klass
    from part
"""


def match_sql(products: str, seed: str) -> str:
    """Oracle of the tiered match over two subqueries (p_partkey, name, klass), (code, hint, example)."""
    return f"""
    with products as ({products}), seed as ({seed}),
    flagged as (
        select *, (name ilike '% and %' or name ilike '% with %' or name like '%/%') as combo
        from products),
    hits as (
        select f.p_partkey, s.code,
               case when lower(trim(f.name)) = lower(trim(s.example)) then 1
                    when lower(f.klass) like '%' || lower(s.hint) || '%' then 2
                    when length(s.example) >= 5
                         and regexp_matches(lower(f.name), '\\b' || lower(s.example) || '\\b')
                         then case when not f.combo then 3 when f.combo then 4 end end as tier
        from flagged f cross join seed s),
    best as (
        select p_partkey, min(tier) as tier, arg_min(code, (tier, code)) as code
        from hits where tier is not null group by p_partkey)
    select f.p_partkey, b.code, f.name, f.klass, f.combo as is_combination_product,
           coalesce(['exact', 'normalized', 'fuzzy', 'combination_unverified'][b.tier], 'unmatched')
               as match_confidence
    from flagged f left join best b using (p_partkey)
    """


MATCH_SQL = match_sql(PRODUCTS_SQL, f"select * from (values {SEED_VALUES}) v(code, hint, example)")


def products(spark, sf_dir):
    sold_as_set = F.concat("p_name", F.lit(" and filler"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, sold_as_set).otherwise(F.col("p_name")).alias("name"),
        F.concat("p_type", F.lit(" [T]")).alias("klass"),
    )


def part_seed(spark):
    rows = spark.createDataFrame(PART_SEED, "code string, hint string, example string")
    return Seed(rows, "code", "hint", "example")


def matched_parts(spark, sf_dir, strategy="auto"):
    return match.tiered_match(
        products(spark, sf_dir), part_seed(spark), ["p_partkey"], "name", "klass", strategy=strategy
    )


@query("tiered_match", MATCH_SQL)
def tiered_match(spark, sf_dir):
    return matched_parts(spark, sf_dir)


BRAND_SEED_SQL = """
    select p_brand || '-' || p_type as code, p_brand as hint, min(p_name) as example
    from part group by p_brand, p_type
"""
BRAND_PRODUCTS_SQL = """
    select p_partkey, case when p_size > 40 then p_name || ' / spare' else p_name end as name,
           case when p_size > 20 then p_brand || ' [B]' end as klass
    from part
"""


@query("tiered_match_index", match_sql(BRAND_PRODUCTS_SQL, BRAND_SEED_SQL))
def tiered_match_index(spark, sf_dir):
    """The same match against a seed made from the data, by equi-join on text pieces."""
    part = table(spark, sf_dir, "part")
    seed = part.groupBy("p_brand", "p_type").agg(F.min("p_name").alias("example"))
    seed = seed.select(
        F.concat("p_brand", F.lit("-"), "p_type").alias("code"), F.col("p_brand").alias("hint"), "example"
    )
    feed = part.select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" / spare")))
        .otherwise(F.col("p_name"))
        .alias("name"),
        F.when(F.col("p_size") > 20, F.concat("p_brand", F.lit(" [B]"))).alias("klass"),
    )
    return match.tiered_match(
        feed, Seed(seed, "code", "hint", "example"), ["p_partkey"], "name", "klass", strategy="index"
    )


REGEX_SEED_SQL = """
    select p_brand || '-' || (p_size % 15) as code, cast(null as varchar) as hint,
           replace(min(p_name), ' ', '.+') as example
    from part group by p_brand, p_size % 15
"""


@query("tiered_match_regex", match_sql(BRAND_PRODUCTS_SQL, REGEX_SEED_SQL))
def tiered_match_regex(spark, sf_dir):
    """Several hundred seed examples that are regexes, made from the part names."""
    part = table(spark, sf_dir, "part")
    seed = part.groupBy("p_brand", (F.col("p_size") % 15).alias("k")).agg(F.min("p_name").alias("example"))
    seed = seed.select(
        F.concat("p_brand", F.lit("-"), F.col("k").cast("string")).alias("code"),
        F.lit(None).cast("string").alias("hint"),
        F.replace("example", F.lit(" "), F.lit(".+")).alias("example"),
    )
    feed = part.select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" / spare"))).otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") > 20, F.concat("p_brand", F.lit(" [B]"))).alias("klass"),
    )
    return match.tiered_match(
        feed, Seed(seed, "code", "hint", "example"), ["p_partkey"], "name", "klass", strategy="index"
    )


@query(
    "match_coverage",
    f"""
    select match_confidence, count(*) as rows,
           round(count(*) / sum(count(*)) over (), 6) as share
    from ({MATCH_SQL}) group by match_confidence
    """,
)
def match_coverage(spark, sf_dir):
    report = match.coverage(matched_parts(spark, sf_dir))
    return report.withColumn("share", F.round("share", 6))


@query(
    "match_exceptions",
    f"""
    select *, 'match: ' || match_confidence as exception_reason from ({MATCH_SQL})
    where match_confidence in ('unmatched', 'combination_unverified')
    """,
)
def match_exceptions(spark, sf_dir):
    return match.match_exceptions(matched_parts(spark, sf_dir))


@query(
    "top_unmatched",
    f"""
    select name, count(*) as rows from ({MATCH_SQL}) where match_confidence = 'unmatched'
    group by name order by rows desc, name limit 10
    """,
)
def top_unmatched(spark, sf_dir):
    return match.top_unmatched(matched_parts(spark, sf_dir), "name", 10)
