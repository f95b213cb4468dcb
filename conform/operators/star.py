"""The star: a conformed two-grain dimension, facts that keep every row, wide serving tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.functions.keys import surrogate_key
from conform.operators import joins
from conform.operators.history import FROM, TO
from conform.operators.match import UNMATCHED

EPOCH = "1900-01-01"  # fixed value: start of validity of category members


@dataclass(frozen=True)
class Lookup:
    """One dimension to resolve: ``on`` fact column -> dimension column, ``take`` column -> new name."""

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    how: str = "left"
    size: str = "auto"


@dataclass(frozen=True)
class Members:
    """Names and provenance of the two member types of a conformed dimension."""

    key: str
    member_type: str
    detail: str
    category: str
    natural_key: str
    code: str
    attributes: Sequence[str]
    # dimension attribute -> category table column
    category_attributes: Mapping[str, str] = field(default_factory=dict)


def conformed_dim(
    history: DataFrame, crosswalk: DataFrame, categories: DataFrame, m: Members
) -> DataFrame:
    """Detail members with their history, plus one member per category code.

    Facts reported by category get a member of their own to point at. Every version of
    a detail member carries *today's* code: the crosswalk is joined by natural key, not
    by version. The tier is NULL on category rows, so they stay out of the coverage
    ratio. A key is hashed from natural key and version start.
    """
    matched = joins.lookup(
        history,
        crosswalk,
        on={m.natural_key: m.natural_key},
        take={
            m.code: m.code,
            "match_confidence": "match_confidence",
            "is_combination_product": "is_combination_product",
        },
        salt_by=[m.natural_key, FROM],
    )
    shape = [m.key, m.member_type, m.natural_key, m.code, *m.attributes]
    tail = ["match_confidence", "is_combination_product", FROM, TO, "is_current"]
    detail = matched.withColumns(
        {
            m.key: surrogate_key(m.natural_key, FROM),
            m.member_type: F.lit(m.detail),
            "match_confidence": F.coalesce("match_confidence", F.lit(UNMATCHED)),
            "is_combination_product": F.coalesce("is_combination_product", F.lit(False)),
            "is_current": F.col(TO).isNull(),
        }
    ).withColumns({FROM: F.col(FROM).cast("date"), TO: F.col(TO).cast("date")})

    def attribute(name: str) -> Column:
        source = m.category_attributes.get(name)
        column = F.col(source) if source else F.lit(None)
        return column.cast(history.schema[name].dataType).alias(name)

    category = categories.select(
        surrogate_key(m.code).alias(m.key),
        F.lit(m.category).alias(m.member_type),
        F.lit(None).cast(history.schema[m.natural_key].dataType).alias(m.natural_key),
        F.col(m.code),
        *[attribute(a) for a in m.attributes],
        F.lit(None).cast("string").alias("match_confidence"),
        F.lit(False).alias("is_combination_product"),
        F.lit(EPOCH).cast("date").alias(FROM),
        F.lit(None).cast("date").alias(TO),
        F.lit(True).alias("is_current"),
    )
    return detail.select(*shape, *tail).unionByName(category)


def _resolve(df: DataFrame, lookups: Sequence[Lookup], row_id: Sequence[str]) -> DataFrame:
    """Apply the lookups in turn; ``row_id`` are columns that tell rows apart.

    Lookups to unique keys leave the keys of the input as they are, so hot keys are
    read from the input itself rather than from the joins built on it so far.
    """
    out = df
    for item in lookups:
        base = df if set(item.on) <= set(df.columns) else None
        out = joins.lookup(
            out, item.dim, dict(item.on), dict(item.take), item.how, item.size, base, row_id
        )
    return out


def build_fact(
    df: DataFrame,
    key: str,
    grain: Sequence[str],
    lookups: Sequence[Lookup],
    measures: Sequence[str],
) -> DataFrame:
    """A fact with a hash key over its grain, resolved foreign keys and its measures.

    Lookups are left joins to tables unique by the joined column, so rows are neither
    dropped nor multiplied. The fact is rebuilt in full: same input, same rows.
    """
    taken = [name for item in lookups for name in item.take.values()]
    return _resolve(df, lookups, grain).select(surrogate_key(*grain).alias(key), *taken, *measures)


def serve(fact: DataFrame, keep: Sequence[str], lookups: Sequence[Lookup]) -> DataFrame:
    """Flatten a fact with its dimensions: inner where the key must resolve, left where it may not."""
    taken = [name for item in lookups for name in item.take.values()]
    return _resolve(fact, lookups, keep).select(*keep, *taken)
