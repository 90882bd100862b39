"""Stints: runs of observations without a long gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scale import skew_join, with_group_max


def stints(
    df: DataFrame,
    entity: str,
    attributes: Sequence[str],
    date: str,
    gap_days: int = 30,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Split the observations of (entity, attributes) where the gap exceeds `gap_days`.

    One row per stint, and per value of the `carry` columns within it: first and
    last date and the number of observations.

    Gaps depend on the distinct dates only. Observations are counted per date
    before any shuffle, and the window sees one row per key and calendar day,
    also with `carry`: the stint of a date is then joined to what was counted.
    """
    keys = [entity, *attributes]
    by_date = Window.partitionBy(*keys).orderBy(date)
    gap = F.date_diff(F.col(date), F.lag(date).over(by_date))

    def numbered(rows: DataFrame) -> DataFrame:
        # The default frame ends at the current date: rows of one date share a stint.
        return rows.withColumn("_starts", F.when(gap > gap_days, 1).otherwise(0)).withColumn(
            "stint_id", F.sum("_starts").over(by_date)
        )

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, *carry, "stint_id").agg(
            F.min(date).alias("observed_from"),
            F.max(date).alias("observed_to"),
            F.sum("_rows").alias("observation_count"),
        )

    daily = df.groupBy(*keys, *carry, date).agg(F.count(F.lit(1)).alias("_rows"))
    if not carry:
        return summed(numbered(daily))
    named = {c: f"_of_{c}" for c in (*keys, date)}
    days = numbered(df.select(*keys, date).distinct()).withColumnsRenamed(named).drop("_starts")
    return summed(skew_join(daily, days, list(named.items()), "inner"))


def flag_current(stint_rows: DataFrame, entity: str, until: str = "observed_to") -> DataFrame:
    """Mark the stints that reach the last date the entity was seen at all."""
    return (
        with_group_max(stint_rows, until, [entity], "_last")
        .withColumn("is_current", F.col(until) == F.col("_last"))
        .drop("_last")
    )


def current_roles(history: DataFrame) -> DataFrame:
    """The stints marked current; an entity may hold several."""
    return history.filter("is_current").drop("is_current")
