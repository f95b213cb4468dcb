"""Tiered entity match between a product list and a reference seed.

For one product and one seed row the first rule that holds gives the tier:

1. ``exact``: the product name equals the seed's example name;
2. ``normalized``: the product class contains the seed's class hint;
3. ``fuzzy``: the example (5 letters or more) is a whole word in the name of a
   single-ingredient product;
4. ``combination_unverified``: the same for a product that lists several ingredients.

The best tier over the seed wins, ties by the smallest code; otherwise ``unmatched``.
As the winner is the minimum of ``(tier, code)`` over all rules that hold, the rules
can be evaluated apart, and seed rows that share a text collapse to their smallest
code beforehand. So there is never a product x seed cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from conform.functions import patterns, text
from conform.operators import bitmaps
from conform.operators.joins import join_back
from conform.session import stored

TIERS = ("exact", "normalized", "fuzzy", "combination_unverified")
UNMATCHED = "unmatched"
MOST_INLINE = 5_000  # seed rows that a plan may hold as literals, and the driver with them
INLINE_ROWS = 64  # tuning: seed rows up to which "auto" makes the match a plain projection
GRAM = 3  # length of the text pieces that index the class hints
REGEX_SIGN = r"[\\^$.|?*+()\[\]{}]"


@dataclass(frozen=True)
class Seed:
    """A reference table and the names of its columns; the code is a string."""

    df: DataFrame
    code: str
    hint: str
    example: str


def tiered_match(
    df: DataFrame,
    seed: Seed,
    key: Sequence[str],
    name: str,
    klass: str,
    min_len: int = 5,
    strategy: str = "auto",
) -> DataFrame:
    """``key.., code, name, klass, is_combination_product, match_confidence``, one row per input row.

    ``strategy="inline"`` writes the seed into the plan as literals: the match is a
    projection, with no join and no shuffle; the plan grows with the seed, of at most ``MOST_INLINE`` rows. ``strategy="index"``
    finds candidates by equi-join on shared text pieces, for any seed. Both give the same
    rows. ``"auto"`` reads at most ``INLINE_ROWS + 1`` seed rows to choose; reading the seed is the
    only action here.
    """
    if strategy not in ("auto", "inline", "index"):
        raise ValueError(f"strategy must be auto, inline or index, not {strategy!r}")
    flagged = df.withColumn("is_combination_product", text.is_combination(name))
    rows = None if strategy == "index" else _seed_rows(seed, (INLINE_ROWS if strategy == "auto" else MOST_INLINE) + 1)
    if strategy == "inline" and len(rows) > MOST_INLINE:
        raise ValueError(f"a seed of more than {MOST_INLINE} rows is matched by index")
    if rows is not None and (strategy == "inline" or len(rows) <= INLINE_ROWS):
        found = _inline_best(flagged, rows, name, klass, min_len)
    else:
        found = _index_best(flagged, seed, key, name, klass, min_len)
    tier = F.get(F.array(*[F.lit(t) for t in TIERS]), F.col("_best.tier") - 1)
    return found.withColumn("_best", _best()).select(
        *key,
        F.col("_best.code").alias(seed.code),
        name,
        klass,
        "is_combination_product",
        F.coalesce(tier, F.lit(UNMATCHED)).alias("match_confidence"),
    )


def _best() -> Column:
    """``(tier, code)`` from ``_exact``, ``_hint`` and ``_word``, the smallest code of each rule.

    The word rule needs a known combination flag: with a NULL name it is NULL and
    neither of its two tiers can hold.
    """
    return F.expr(
        """case when _exact is not null then struct(1 as tier, _exact as code)
                when _hint is not null then struct(2 as tier, _hint as code)
                when _word is not null and not is_combination_product
                    then struct(3 as tier, _word as code)
                when _word is not null and is_combination_product
                    then struct(4 as tier, _word as code) end"""
    )


# --- small seed: literals -----------------------------------------------------------------


def _seed_rows(seed: Seed, most: int) -> list[Row]:
    rows = (
        seed.df.where(F.col(seed.code).isNotNull())
        .select(
            F.col(seed.code).alias("code"),
            F.lower(seed.hint).alias("hint"),
            text.folded(seed.example).alias("folded"),
            F.lower(seed.example).alias("word"),
            F.length(seed.example).alias("size"),
        )
    )
    return rows.limit(most).collect()


def _inline_best(
    flagged: DataFrame, rows: list[Row], name: str, klass: str, min_len: int
) -> DataFrame:
    # In code order, so the first hit of a coalesce is the smallest code.
    ordered = sorted(rows, key=lambda r: r.code)
    folded, lowered, lowered_class = text.folded(name), F.lower(name), F.lower(klass)

    def first(hits: list[Column]) -> Column:
        return F.coalesce(F.lit(None).cast("string"), *hits)

    exact = [F.when(folded == r.folded, r.code) for r in ordered if r.folded is not None]
    hint = [
        F.when(text.like_containing(lowered_class, F.lit(r.hint)), F.lit(r.code))
        for r in ordered
        if r.hint is not None
    ]
    word = [
        F.when(text.whole_word(lowered, F.lit(r.word)), F.lit(r.code))
        for r in ordered
        if r.word is not None and r.size >= min_len
    ]
    # One projection per rule: each runs once per row, and only where no better one held.
    return (
        flagged.withColumn("_exact", first(exact))
        .withColumn("_hint", F.when(F.col("_exact").isNull(), first(hint)))
        .withColumn(
            "_word", F.when(F.col("_exact").isNull() & F.col("_hint").isNull(), first(word))
        )
    )


# --- large seed: equi-joins on text pieces --------------------------------------------------


def _index_best(
    flagged: DataFrame, seed: Seed, key: Sequence[str], name: str, klass: str, min_len: int
) -> DataFrame:
    """Match the distinct names and the distinct classes, then join the answers back.

    A piece of text that very many names share is split over tasks by the adaptive
    skew join; the products themselves, where one name may be hot, are salted.
    """
    names = flagged.select(F.col(name).alias("_n")).where("_n is not null").distinct()
    classes = flagged.select(F.col(klass).alias("_c")).where("_c is not null").distinct()
    example = F.col(seed.example)
    examples = _smallest_code(seed.df.where(F.length(example) >= min_len), seed, F.lower(example))
    folded = _smallest_code(seed.df, seed, text.folded(example))
    hints = _smallest_code(seed.df, seed, F.lower(seed.hint))

    exact = names.join(folded, text.folded("_n") == F.col("term"))
    by_name = (
        exact.selectExpr("_n", "code as _exact", "cast(null as string) as _word")
        .unionByName(
            _word_hits(names, examples).selectExpr("_n", "cast(null as string) as _exact", "code as _word")
        )
        .groupBy("_n")
        .agg(F.min("_exact").alias("_exact"), F.min("_word").alias("_word"))
    )
    by_class = (
        _gram_hits(classes, "_c", hints, text.like_containing)
        .groupBy("_c")
        .agg(F.min("code").alias("_hint"))
    )
    keyed = flagged.withColumns({"_n": F.col(name), "_c": F.col(klass)})
    named = join_back(keyed, by_name, ["_n"], key, keyed)
    return join_back(named, by_class, ["_c"], key, keyed)


def _smallest_code(rows: DataFrame, seed: Seed, term: Column) -> DataFrame:
    """Seed rows that share a text collapse to their smallest code, which is what a tie picks."""
    return (
        rows.select(term.alias("term"), F.col(seed.code).alias("code"))
        .where("term is not null and code is not null")
        .groupBy("term")
        .agg(F.min("code").alias("code"))
    )


def _with_rarest(index: DataFrame, pieces: str) -> DataFrame:
    """``index`` with ``piece``: of each row's pieces the one that the fewest other terms have."""
    exploded = index.withColumn("piece", F.expr(f"explode(array_distinct({pieces}))"))
    common = exploded.groupBy("piece").agg(F.expr("count(1) as n"))
    return (
        exploded.join(common, "piece")
        .groupBy(*index.columns)
        .agg(F.expr("min(struct(n, piece)) as pick"))
        .select(*index.columns, F.expr("pick.piece as piece"))
    )


def _word_hits(names: DataFrame, index: DataFrame) -> DataFrame:
    """``(_n, code)``: names that hold a seed example as a whole word.

    Where plain text matches between word boundaries, each of its runs of ``a-z0-9``
    is a complete run of the name, so the rarest of them is the join key and the
    regex confirms. Text without such a run (another script) is found by its grams, and an example
    that is a regex by the grams of what its matches must hold.
    """
    plain = ~F.col("term").rlike(REGEX_SIGN)
    latin = F.col("term").rlike("[a-z0-9]")
    runs = "filter(split({}, '[^a-z0-9]+'), w -> w != '')"

    keyed = _with_rarest(index.where(plain & latin), runs.format("term"))
    tokens = names.selectExpr("_n", f"explode(array_distinct({runs.format('lower(_n)')})) as piece")
    found = tokens.join(keyed, "piece").where(text.whole_word(F.lower("_n"), F.col("term")))
    return (
        found.select("_n", "code")
        .unionByName(_gram_hits(names, "_n", index.where(plain & ~latin), text.whole_word))
        .unionByName(_regex_hits(names, index.where(~plain)))
    )


def _grams(string: str, size: int) -> str:
    """SQL of all substrings of a size; a single NULL when the string is shorter."""
    return (
        f"transform(sequence(0, greatest(length({string}) - {size}, 0)), "
        f"i -> if(i + {size} <= length({string}), substring({string}, i + 1, {size}), null))"
    )


def _with_gram(index: DataFrame, runs: str) -> DataFrame:
    """``index`` with the rarest ``piece`` of its literal runs: a 3-gram, or all there is of shorter runs."""
    longest = f"coalesce(array_max(transform({runs}, r -> length(r))), 0)"

    def of_size(n: int) -> str:
        return f"array_compact(flatten(transform({runs}, r -> {_grams('r', n)})))"

    by_length = f"case {longest} when 0 then array() when 1 then {of_size(1)} when 2 then {of_size(2)}"
    return _with_rarest(index, f"{by_length} else {of_size(GRAM)} end")


def owned_pieces(texts: DataFrame, column: str, pieces: DataFrame) -> DataFrame:
    """``(column, _t, piece)``: the pieces that a lower-cased text holds, of those in ``pieces``.

    Only grams of sizes that occur there are cut, and a bitmap of the pieces (of fixed size) drops the
    others before a row is made, so a text costs about as many rows as it has hits. A false hit finds no partner in the join.
    """
    sizes = sorted(r["n"] for r in pieces.select(F.length("piece").alias("n")).distinct().collect())  # 1, 2, 3 at most
    lowered = texts.selectExpr(column, f"lower({column}) as _t")
    if not sizes:
        return lowered.withColumn("piece", F.lit("")).limit(0)
    known = bitmaps.bitmap(pieces, bitmaps.key_hash("piece"))
    cut = F.expr(f"array_distinct(array_compact(concat({', '.join(_grams('_t', n) for n in sizes)})))")
    return lowered.withColumn("piece", F.explode(F.filter(cut, lambda g: bitmaps.maybe_in(known, bitmaps.key_hash(g)))))


def _gram_hits(
    texts: DataFrame, column: str, index: DataFrame, test: Callable[[Column, Column], Column]
) -> DataFrame:
    """``(column, code)``: texts that contain a seed term.

    A text that contains a term has every gram of the term's literal runs (the parts
    between wildcards). Runs of three characters or more give 3-grams, shorter ones
    a 2- or 1-gram. A term of wildcards only has none and is tried on every text.
    """
    literal = F.col("term").rlike("[^%_]")
    keyed = stored(_with_gram(index.where(literal), "filter(split(term, '[%_]'), r -> r != '')"), "match-grams")
    found = owned_pieces(texts, column, keyed).join(keyed, "piece").where(test(F.col("_t"), F.col("term")))
    return found.select(column, "code").unionByName(_tried_in_turn(texts, column, index.where(~literal), test))


def regex_trials(names: DataFrame, index: DataFrame) -> DataFrame:
    """``(_n, term, code)``: the names on which a regex is tried, as they hold all literal runs of one way to match it.

    ``index`` has ``ways`` beside ``term`` and ``code``; see :func:`~conform.functions.patterns.literal_runs`. Each way is found
    by the rarest gram of its runs.
    """
    ways = index.select("term", "code", F.explode("ways").alias("runs"))
    keyed = stored(_with_gram(ways, "runs"), "match-runs")
    held = F.forall("runs", lambda r: F.contains(F.col("_t"), r))
    return owned_pieces(names, "_n", keyed).join(keyed, "piece").where(held).select("_n", "term", "code").distinct()


def _regex_hits(names: DataFrame, index: DataFrame) -> DataFrame:
    """Names that match a seed example that is a regex: those that hold what its matches must hold try it.

    A regex that says nothing about its matches (wildcards only) is tried on every name.
    """
    parsed = index.withColumn("ways", patterns.literal_runs(F.col("term")))
    tried = regex_trials(names, parsed.where("ways is not null")).where(text.whole_word(F.lower("_n"), F.col("term")))
    return tried.select("_n", "code").unionByName(_tried_in_turn(names, "_n", parsed.where("ways is null"), text.whole_word))


def _tried_in_turn(
    texts: DataFrame, column: str, index: DataFrame, test: Callable[[Column, Column], Column]
) -> DataFrame:
    """Smallest code among terms without any literal text, on every text.

    They are tried in the order of their codes up to the first that holds, and ride along as one array: terms
    that differ in wildcards only, of which a seed has few.
    """
    terms = index.agg(F.expr("array_sort(collect_list(struct(code, term))) as terms"))

    def step(found: Column, t: Column) -> Column:
        return F.when(found.isNull() & test(F.lower(column), t["term"]), t["code"]).otherwise(found)

    first = F.aggregate("_terms", F.lit(None).cast("string"), step)
    return texts.withColumn("_terms", terms.scalar()).select(column, first.alias("code")).where("code is not null")


# --- reports over a match -------------------------------------------------------------------


def coverage(matched: DataFrame, tier: str = "match_confidence") -> DataFrame:
    """Rows and share per tier. Rows without a tier are not part of the denominator."""
    counts = matched.where(F.col(tier).isNotNull()).groupBy(tier).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total)


def key_coverage(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of rows whose foreign key is resolved, one row per key, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(k).alias(k) for k in keys])
    rows = [
        F.struct(
            F.lit(k).alias("key"),
            F.col(k).alias("resolved"),
            F.col("_rows").alias("total"),
            (F.col(k) / F.when(F.col("_rows") > 0, F.col("_rows"))).alias("share"),
        )
        for k in keys
    ]
    return one.select(F.inline(F.array(*rows)))


def exceptions(df: DataFrame, condition: Column, reason: str | Column) -> DataFrame:
    """Rows to quarantine, each with its reason."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.where(condition).withColumn("exception_reason", why)


def match_exceptions(matched: DataFrame, tiers: Sequence[str] = (UNMATCHED, TIERS[3])) -> DataFrame:
    tier = F.col("match_confidence")
    return exceptions(matched, tier.isin(*tiers), F.concat(F.lit("match: "), tier))


def top_unmatched(matched: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` most frequent names without a match, for the steward who extends the seed."""
    return (
        matched.where(F.col("match_confidence") == UNMATCHED)
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.col(name).asc_nulls_last())
        .limit(n)
    )
