"""Hash keys and calendar keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder hashed in place of NULL, so that keys agree with
# marts already keyed by the public surrogate-key macro.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the text of the columns, joined by ``-``; NULL hashes as a token.

    Do not pass floating-point columns: their text form differs between engines.
    """
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: str | Column) -> Column:
    """20140102 for 2014-01-02."""
    return F.date_format(as_column(c), "yyyyMMdd").cast("int")
