"""Text clean-up and text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from conform.functions.keys import as_column

# Patterns the results depend on.
NON_ALPHANUMERIC = "[^a-z0-9]"
HTML_TAG = "<[^>]+>"


def normalise(c: str | Column) -> Column:
    """Lower-case, trim, keep only ``a-z0-9``."""
    return F.regexp_replace(F.lower(F.trim(as_column(c))), NON_ALPHANUMERIC, "")


def folded(c: str | Column) -> Column:
    """Lower-case and trim, for exact comparison of names."""
    return F.lower(F.trim(as_column(c)))


def join_items(c: str | Column, sep: str = "; ") -> Column:
    """``['a', NULL, 'b']`` -> ``'a; b'``; empty -> ``''``; NULL -> NULL."""
    return F.array_join(as_column(c), sep)


def first_item(c: str | Column) -> Column:
    """First element, NULL when the array is empty or NULL."""
    return F.get(as_column(c), F.lit(0))


def is_combination(name: str | Column) -> Column:
    """True when a product name lists several ingredients; NULL for a NULL name."""
    c = as_column(name)
    # fixed values: the marks of a combination
    return c.ilike("% and %") | c.ilike("% with %") | c.like("%/%")


def like_containing(haystack: Column, needle: Column) -> Column:
    """``haystack LIKE '%needle%'`` where ``%`` and ``_`` inside the needle stay wildcards.

    LIKE without an escape character is meant, so a backslash is made literal.
    """
    literal = F.replace(needle, F.lit("\\"), F.lit("\\\\"))
    return F.like(haystack, F.concat(F.lit("%"), literal, F.lit("%")))


def whole_word(haystack: Column, word: Column) -> Column:
    """True when ``word`` (a regex, not escaped) occurs between word boundaries."""
    return F.rlike(haystack, F.concat(F.lit(r"\b"), word, F.lit(r"\b")))
