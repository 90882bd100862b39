"""Snapshot tables: stamping, the load manifest and the latest snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp_snapshot(
    df: DataFrame,
    group: str,
    observed_at: dt.datetime,
    group_col: str = "group_name",
    ts_col: str = "_accessed_at",
) -> DataFrame:
    """Add the top-level group and the load time to every row of one load."""
    return df.withColumns(
        {group_col: F.lit(group), ts_col: F.lit(observed_at).cast("timestamp_ntz")}
    )


def load_manifest(
    tables: Mapping[str, DataFrame],
    group: str = "group_name",
    ts: str = "_accessed_at",
    durations: DataFrame | None = None,
) -> DataFrame:
    """One row per table, group and load: the number of rows and the duration.

    `durations` holds `group`, `ts` and `extraction_duration_seconds` per load.
    Every load in it is listed for every table, with 0 where it brought no rows.
    """
    counted = [
        df.groupBy(group, ts)
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.lit(name).alias("table_name"), group, "num_rows", ts)
        for name, df in tables.items()
    ]
    if durations is None:
        counts = reduce(DataFrame.unionByName, counted)
        return counts.withColumn("extraction_duration_seconds", F.lit(None).cast("double"))
    names = F.explode(F.array(*[F.lit(name) for name in tables]))
    none = durations.select(
        names.alias("table_name"), group, F.lit(0).cast("long").alias("num_rows"), ts
    )
    counts = (
        reduce(DataFrame.unionByName, [*counted, none])
        .groupBy("table_name", group, ts)
        .agg(F.sum("num_rows").alias("num_rows"))
    )
    return counts.join(durations, [group, ts], "left")


def latest_snapshot(
    df: DataFrame,
    columns: Sequence[str],
    ts: str = "_accessed_at",
    day: str | None = None,
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> DataFrame:
    """Distinct rows of the last snapshot date, valid from and to their load time.

    Name the date column the table is partitioned by as `day`: only the last
    partition is then read.
    """
    date = F.to_date(ts) if day is None else F.col(day)
    last = df.agg(F.max(date).alias("day")).scalar()
    return (
        df.filter(date == last)
        .select(*columns, F.col(ts).alias(valid_from), F.col(ts).alias(valid_to))
        .distinct()
    )
