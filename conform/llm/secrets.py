"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import bits_of, fresh, read, stored, with_bit

# Kind -> (pattern, group that holds the value, least length of that group). A run
# with a least length inside the pattern finds what the open run, filtered, would find.
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
RUN = 512  # matches that one fold takes
#: Kind of the spans that the ownership step adds.
LIVE = "live"
ORDER = [*KINDS, LIVE]

_MATCH = "array<struct<start:int,end:int,value:string>>"


def _matches(text: Column, kind: str) -> Column:
    """Matches of one kind, left to right, with code-point offsets and the value.

    The gaps between matches and the matches themselves add up to the text, so a fold over
    both gives every offset; the value is the tail of its match. Matches are folded ``RUN`` at a time, and a
    second fold over the runs' lengths shifts them: a fold copies what it has found so far at every step, so it must stay short.
    """
    pattern, group, least = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        hit = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        fits = F.length(x["value"]) >= least
        return F.struct(end.alias("at"), F.when(fits, F.array_append(state["hits"], hit)).otherwise(state["hits"]).alias("hits"))

    empty = F.array().cast(_MATCH)
    start = F.struct(F.lit(0).alias("at"), empty.alias("hits"))

    def folded(found: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(found), F.lit(RUN))
        runs = F.transform(places, lambda i: F.aggregate(F.slice(found, i, RUN), start, step))

        def shifted(runs: Column) -> Column:
            bases = F.aggregate(runs, F.array(F.lit(0)), lambda done, r: F.array_append(done, F.element_at(done, -1) + r["at"]))

            def moved(bases: Column) -> Column:
                def move(r: Column, i: Column) -> Column:
                    base = F.get(bases, i)
                    shift = lambda h: F.struct((h["start"] + base).alias("start"), (h["end"] + base).alias("end"), h["value"].alias("value"))
                    return F.transform(r["hits"], shift)

                return F.flatten(F.transform(runs, move))

            return _let(bases, moved)

        return _let(runs, shifted)

    matched = F.filter(pairs, lambda x: x["whole"].isNotNull())
    return F.when(text.rlike(pattern), _let(matched, folded)).otherwise(empty)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spelt(hits: Column) -> Column:
    """kind:start:end of (start, place of the kind, end) triples, by start, then kind."""
    names = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(
        F.transform(
            F.array_sort(hits), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])
        ),
        ",",
    )


def _placed(hits: Column, kind: str) -> Column:
    place = F.lit(ORDER.index(kind))
    return F.transform(hits, lambda x: F.struct(x["start"].alias("start"), place.alias("kind"), x["end"].alias("end")))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str | None = None,
    max_owners: int = 1,
    max_repos: int | None = None,
    min_length: int = 16,
    any_form: bool = True,
) -> DataFrame:
    """Candidate secrets of each text, and which of them look live.

    Every whole text is scanned for the patterns of :data:`KINDS`. The hash of each candidate's
    value is counted over the corpus: in how many distinct repositories (``repo_col``; each
    document is its own if None) and owners it occurs. A value that spreads beyond ``max_repos`` or
    ``max_owners`` is a copied example. The others look live, and each of their places gets a span of kind
    ``live`` around the value, on top of the pattern's own span. Where no column names a repository, documents stand for
    it; as copies of one owner's document would count against its own values, owners alone judge unless ``max_repos`` is given. Without
    ``any_form`` a value looks live only if it has ``min_length`` characters, a letter, a digit and eight different characters.

    Returns one row per input row: the id, ``base`` and ``live`` (arrays of start, kind, end; code
    points, end exclusive), ``values`` (start, end, value, owners, repos, live) and ``text_sha``. A null text is an empty
    one. A null owner or repository counts as one of its own. Rows that repeat an id are scanned
    each; the ownership counts see their pair of owner and repository once. Empty input gives no rows, other columns
    are ignored. A value with a third of all occurrences is counted map-side first and
    reaches the final join as one row, where adaptive execution may split the other side.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    repo = F.col(repo_col or id_col)
    scanned = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        F.sha2(text, 256).alias("text_sha"),
        *[_matches(text, kind).alias(kind) for kind in KINDS],
    ).withColumn("row", F.monotonically_increasing_id())
    scanned = stored(scanned, "secrets-scan")

    found = F.flatten(F.array(*[F.transform(kind, lambda x: F.struct(
        F.when(F.lit(kind == "assign"), x["end"] - F.length(x["value"])).otherwise(x["start"]).alias("start"),
        x["end"].alias("end"), x["value"].alias("value"))) for kind in KINDS]))
    places = (
        scanned.select("row", "owner", "repo", F.explode(found).alias("x"))
        .select("row", "owner", "repo", "x.*")
        .withColumn("hash", F.sha2("value", 256))
    )
    spread = (
        places.select("hash", "owner", "repo").distinct()
        .groupBy("hash", "owner").agg(F.count("*").alias("repos"))
        .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    )
    spread = stored(spread, "secrets-spread")
    looks = F.lit(any_form) | (
        (F.length("value") >= min_length)
        & F.col("value").rlike("[0-9]")
        & F.col("value").rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split("value", ""))) >= 8)
    )
    owned = F.col("owners") <= max_owners
    if max_repos is not None:
        owned &= F.col("repos") <= max_repos
    judged = places.join(spread, "hash").withColumn("live", looks & owned)
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "value", "owners", "repos", "live"))).alias("values")
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string,owners:bigint,repos:bigint,live:boolean>>")
    return (
        scanned.join(per_row, "row", "left")
        .withColumn("values", F.coalesce("values", empty))
        .select(
            F.col("id").alias(id_col),
            *KINDS,
            F.concat(*[_placed(F.col(kind), kind) for kind in KINDS]).alias("base"),
            _placed(F.filter("values", lambda x: x["live"]), LIVE).alias("live"),
            "values",
            "text_sha",
        )
    )


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]", **options) -> DataFrame:
    """The documents with every live-looking value replaced by ``mask``; all columns and rows stay.

    A null text stays null; columns of any name stay. Equal texts are masked alike where any of them has a live value: their spans are joined
    on the text's hash, and a bitmap of fixed size spares all other texts the shuffle.
    """
    found = scan_secrets(docs, text_col=text_col, **options).where(F.size("live") > 0)
    hits = stored(found.select("text_sha", "live").groupBy("text_sha").agg(F.max("live").alias("live")), "secrets-live")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)

    def step(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        gap = F.substring(F.col(text_col), state["at"] + 1, x["start"] - state["at"])
        return F.struct(
            F.greatest(x["end"], state["at"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"),
        )

    own_sha, own_live, maybe = fresh(docs, stem="sha"), fresh(docs, stem="live"), fresh(docs, stem="maybe")
    masked = F.aggregate(
        F.array_sort(own_live),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda s: F.concat(s["out"], F.substring(F.col(text_col), s["at"] + 1, F.length(text_col))),
    )
    marked = with_bit(docs, bits_of(hits, "text_sha"), sha, maybe)
    masked_rows = (
        marked.where(F.col(maybe)).withColumn(own_sha, sha).join(hits.select(F.col("text_sha").alias(own_sha), F.col("live").alias(own_live)), own_sha, "left")
        .withColumn(text_col, F.when(F.col(own_live).isNull(), F.col(text_col)).otherwise(masked))
    )
    return marked.where(~F.col(maybe)).select(docs.columns).unionByName(masked_rows.select(docs.columns))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = scan_secrets(read(spark, sf_dir, "documents"))
    return hits.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_spelt(F.col("base")), 256).alias("base_sha256"),
        _spelt(F.concat("base", "live")).alias("spans"),
    )


def _sql_kind(kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  select r, '{kind}' as kind, {ORDER.index(kind)} as place, start, start + len(whole) as stop, value,
         {"start + len(whole) - len(value)" if group else "start"} as value_start
  from (
    select r, whole, value, cast(list_sum(list_transform(gaps[:i], lambda x: len(x)))
           + coalesce(list_sum(list_transform(wholes[:i - 1], lambda x: len(x))), 0) as bigint) as start
    from (
      select r, i, wholes, gaps, wholes[i] as whole, vals[i] as value from (
        select r, wholes, gaps, vals, unnest(range(1, len(wholes) + 1)) as i from (
          select r, regexp_extract_all(text, '{pattern}') as wholes, regexp_extract_all(text, '{pattern}', {group}) as vals,
                 string_split_regex(text, '{pattern}') as gaps
          from d where regexp_matches(text, '{pattern}')
        )
      )
    )
  ) where len(value) >= {least}"""


def _sql() -> str:
    """DuckDB text; the keywords are spelt letter by letter, as its (?i) also folds beyond ASCII."""
    words = "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
        for word in ("password", "passwd", "secret", "token", "api_?key")
    )
    assign = rf"""({words})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    patterns = {"assign": assign, "access": KINDS["access"][0], "hex": KINDS["hex"][0]}
    base = " union all ".join(_sql_kind(k, patterns[k], g, n) for k, (_, g, n) in KINDS.items())
    spelt = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, place)"
    return f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, coalesce(source, '') as owner from documents
), base as ({base}
), spread as (
  select value, count(distinct owner) as owners
  from base join d using (r) group by value
), live as (
  select distinct r, '{LIVE}' as kind, {ORDER.index(LIVE)} as place, value_start as start, stop
  from base join spread using (value)
  where owners <= 1
), b as (
  select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex, {spelt} as spelt
  from base group by r
), a as (
  select r, {spelt} as spelt
  from (select r, kind, place, start, stop from base union all select r, kind, place, start, stop from live) group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(b.spelt, '')) as base_sha256, coalesce(a.spelt, '') as spans
from d left join b using (r) left join a using (r)
"""


SQL = _sql()
