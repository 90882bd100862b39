"""Percentages and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower edges of the report bands, highest first.
BANDS = (("high", 80.0), ("medium", 50.0))
LOWEST_BAND = "low"


def share(part: Column, total: Column) -> Column:
    """`part` as a percentage of `total`, 0 when the total is 0."""
    return F.when(total > 0, part.cast("double") * 100 / total).otherwise(F.lit(0.0))


def band(pct: Column | str) -> Column:
    """Name of the band a percentage falls in."""
    pct = F.col(pct) if isinstance(pct, str) else pct
    picked = None
    for name, edge in BANDS:
        picked = F.when(pct >= edge, name) if picked is None else picked.when(pct >= edge, name)
    return picked.otherwise(F.lit(LOWEST_BAND))
