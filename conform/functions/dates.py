"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from conform.functions.keys import as_column

# Text formats of the sources, and the last year a two-digit
# year may mean (69..99 are 1969..1999).
COMPACT = "yyyyMMdd"
DAY_MON_YY = "d MMM yy"
LAST_SHORT_YEAR = 2068


def parse_compact(c: str | Column, strict: bool = True) -> Column:
    """``20140102`` -> date. Bad text raises, or gives NULL when not strict."""
    text = as_column(c)
    return F.to_date(text, COMPACT) if strict else F.try_to_date(text, COMPACT)


def parse_day_mon_yy(c: str | Column, strict: bool = True) -> Column:
    """``20-May-12`` or ``1-Jan-08`` -> date; month names in any case."""
    text = F.initcap(F.replace(as_column(c), F.lit("-"), F.lit(" ")))
    day = F.to_date(text, DAY_MON_YY) if strict else F.try_to_date(text, DAY_MON_YY)
    return F.when(F.year(day) > LAST_SHORT_YEAR, F.add_months(day, -1200)).otherwise(day)


def unparsed(text: str | Column, parsed: str | Column) -> Column:
    """Flag for a tolerant parse: there was text but no date came of it."""
    return as_column(text).isNotNull() & as_column(parsed).isNull()


def weekday_name(c: str | Column) -> Column:
    """Full English name: ``Tuesday``."""
    return F.date_format(as_column(c), "EEEE")
