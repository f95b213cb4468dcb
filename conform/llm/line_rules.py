"""Line-first cleaning by quality rules, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import read

# Patterns that Java and RE2 read alike.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: A mark that ends a sentence, at the end of a word or, in scripts without blanks, anywhere.
SENTENCE = r"""[.!?\x{2026}]["'\x{201D}\x{2019}\x{00BB})\]]*([\x20\x09-\x0D]|\z)|[\x{3002}\x{FF01}\x{FF1F}]"""
SHOUT = r"[!?]{2,}"
DECORATION = r"[#*$%&<>]"
SEPARATOR = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}]"
LINKS = [
    "home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next", "previous", "back", "back to top", "share",
    "contact", "contact us", "about", "about us", "read more", "click here", "skip to content", "site map", "sitemap",
]
BOILERPLATE = [
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "we use cookies", "uses cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter",
]
RULES = ("punctuation", "navigation", "boilerplate")
WINDOW = 5  # words of a window that may repeat


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern, -1)) - 1


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words that occurs twice or more, the first one included.

    Runs are compared by 64-bit hashes. They are sorted with their places, so equal ones are neighbours, and the places
    are swept once: n log n in the number of words.
    """

    def covered(runs: Column) -> Column:
        placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, i: F.coalesce(x["h"] == F.get(s, i)["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

        def sweep(state: Column, i: Column) -> Column:
            fresh = F.least(F.lit(window), i + window - state["end"])
            return F.struct((i + window).alias("end"), (state["n"] + fresh).alias("n"))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(_let(placed, twice), start, sweep, lambda s: s["n"])

    def runs_of(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(window)]))

    zero = F.lit(0).cast("long")
    none = lambda runs: F.when(F.size(F.array_distinct(runs)) == F.size(runs), zero).otherwise(covered(runs))
    some = _let(_let(F.transform(words, lambda w: F.xxhash64(w)), runs_of), none)
    return F.when(F.size(words) <= window, zero).otherwise(some)


def failed_rule(line: Column, links: list[str] = LINKS, boilerplate: list[str] = BOILERPLATE) -> Column:
    """The first of :data:`RULES` that a line with a word fails, or null.

    * punctuation: no mark ends a sentence, or more than a fifth as many runs of ``!`` and ``?`` as words, or more
      than a quarter as many decorating marks as words;
    * navigation: two separators or more and more than one for five words, or the whole line is a link text;
    * boilerplate: the line holds one of the phrases, in any case.
    """

    def judge(x: Column) -> Column:
        words, lower = x["words"], x["lower"]
        separators = _count(line, SEPARATOR)
        bare = F.regexp_replace(lower, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
        phrase = F.lit(False)
        for p in boilerplate:
            phrase |= F.contains(lower, F.lit(p))
        return (
            F.when((separators >= 2) & (5 * separators > words), F.lit("navigation"))
            .when((words <= 3) & bare.isin(links), F.lit("navigation"))
            .when(phrase, F.lit("boilerplate"))
            .when(~line.rlike(SENTENCE), F.lit("punctuation"))
            .when(5 * _count(line, SHOUT) > words, F.lit("punctuation"))
            .when(4 * _count(line, DECORATION) > words, F.lit("punctuation"))
        )

    return _let(F.struct(F.regexp_count(line, F.lit(WORD)).alias("words"), F.lower(line).alias("lower")), judge)


def clean_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_lost: int = 50,
    min_words: int = 10,
    max_repeated: int = 20,
) -> DataFrame:
    """Each text's lines judged by rules first, then the document by what the failing lines take away.

    Lines (between ``\\n``) that fail a rule of :func:`failed_rule` are removed; a document that loses more than
    ``max_lost`` percent of the characters of its words this way is rejected, and so is one that fails the base rule: fewer than ``min_words`` words, or more
    than ``max_repeated`` percent of them repeated.

    Returns one row per input row: the id, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines
    with a word that equal an earlier line), ``n_repeat_words``, ``base_failed``, ``n_punctuation``, ``n_navigation``, ``n_boilerplate``
    (lines removed by the first rule they fail), ``lost_chars``, ``kept`` and ``clean_text`` (the lines that passed and those
    without words). Words are maximal runs without ASCII white space. A null text is an empty one: it has no words and fails the base
    rule. Whole texts are read, of any length: nothing is quadratic in a text. Rows that repeat an id are judged each, ties
    do not occur, other columns are ignored, no rows in give no rows out. There is no shuffle.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def judged(line: Column) -> Column:
        wordless = ~line.rlike(WORD)
        chars = F.length(F.regexp_replace(line, r"[\x20\x09-\x0D]+", ""))
        return F.struct(line.alias("line"), chars.alias("chars"), wordless.alias("wordless"), F.when(~wordless, failed_rule(line)).alias("why"))

    read_once = docs.select(F.col(id_col), text.alias("_text")).select(
        id_col,
        F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.transform(F.split("_text", "\n", -1), judged).alias("_lines"),
        _count(F.col("_text"), SYMBOL).cast("long").alias("n_symbols"),
    )
    def failing(rule: str) -> Column:
        return F.size(F.filter("_lines", lambda x: F.coalesce(x["why"] == rule, F.lit(False)))).cast("long")

    worded = F.transform(F.filter("_lines", lambda x: ~x["wordless"]), lambda x: x["line"])
    zero = F.lit(0).cast("long")
    lost = F.aggregate("_lines", zero, lambda n, x: n + F.when(x["why"].isNotNull(), x["chars"]).otherwise(0))
    measured = read_once.select(
        id_col,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        _let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        *[failing(r).alias(f"n_{r}") for r in RULES],
        lost.alias("lost_chars"),
        F.array_join(F.transform(F.filter("_lines", lambda x: x["why"].isNull()), lambda x: x["line"]), "\n").alias("clean_text"),
    )
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    fine = 100 * F.col("lost_chars") <= max_lost * F.col("word_chars")
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & fine)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(read(spark, sf_dir, "documents")).drop("clean_text")


def _sql() -> str:
    phrases = " or ".join(f"contains(lower, '{p}')" for p in BOILERPLATE)
    links = ", ".join(f"'{p}'" for p in LINKS)
    quoted = SENTENCE.replace("'", "''")
    removed = ", ".join(f"count(*) filter (why = '{r}') as n_{r}" for r in RULES)
    return rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws from documents
), lines as (
  select r, i, line, lower(line) as lower, len(regexp_extract_all(line, '{WORD}')) as words,
         len(regexp_extract_all(line, '{SEPARATOR}')) as seps
  from (select r, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as i from (select r, string_split(t, chr(10)) as ls from d))
  where regexp_matches(line, '{WORD}')
), judged as (
  select r, i, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) as chars,
         case when seps >= 2 and 5 * seps > words then 'navigation'
              when words <= 3 and regexp_replace(lower, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g') in ({links}) then 'navigation'
              when {phrases} then 'boilerplate'
              when not regexp_matches(line, '{quoted}') then 'punctuation'
              when 5 * len(regexp_extract_all(line, '{SHOUT}')) > words then 'punctuation'
              when 4 * len(regexp_extract_all(line, '{DECORATION}')) > words then 'punctuation' end as why
  from lines
), by_line as (
  select r, count(*) - count(distinct line) as n_dup_lines, {removed},
         cast(coalesce(sum(chars) filter (why is not null), 0) as bigint) as lost_chars
  from judged group by r
), runs as (
  select r, i, ws[i : i + {WINDOW - 1}] as run
  from (select r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from d where len(ws) >= {WINDOW})
), twice as (
  select r, i from (select r, i, count(*) over (partition by r, run) as n from runs) where n > 1
), repeated as (
  select r, count(distinct place) as n_repeat_words from (select r, i + unnest(range(0, {WINDOW})) as place from twice) group by r
), m as (
  select doc_id, cast(len(ws) as bigint) as n_words, cast(length(list_aggregate(ws, 'string_agg', '')) as bigint) as chars,
         cast(len(regexp_extract_all(t, '{SYMBOL}')) as bigint) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, {", ".join(f"coalesce(n_{x}, 0) as n_{x}" for x in RULES)}, coalesce(lost_chars, 0) as lost_chars
  from d left join by_line using (r) left join repeated using (r)
)
select * exclude (chars), coalesce(chars, 0) as word_chars, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 100 * lost_chars <= 50 * coalesce(chars, 0) as kept
from m
"""


SQL = _sql()
