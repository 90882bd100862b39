"""Date clean-up and elapsed time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def remap_dates(col: Column | str, moves: Mapping[dt.date, dt.date]) -> Column:
    """The date of `col`, with the listed dates moved to others."""
    day = (F.col(col) if isinstance(col, str) else col).cast("date")
    if not moves:
        return day
    known = F.create_map(*[F.lit(d) for pair in moves.items() for d in pair])
    return F.coalesce(F.try_element_at(known, day), day)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)
