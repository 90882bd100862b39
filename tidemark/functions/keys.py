"""Content and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for null inside a surrogate key, so that null and '' differ.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _text(col: Column | str, default: str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(default))


def content_key(*cols: Column | str) -> Column:
    """md5 of the values put end to end, null as ''.

    Nothing separates the values, so ('ab', 'c') and ('a', 'bc') share a key.
    """
    return F.md5(F.concat(*[_text(c, "") for c in cols]))


def surrogate_key(*cols: Column | str, null_token: str = NULL_TOKEN) -> Column:
    """md5 of the values joined by '-', null kept apart from the empty string."""
    return F.md5(F.concat_ws("-", *[_text(c, null_token) for c in cols]))
