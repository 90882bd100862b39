"""Validity intervals (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def last_seen(scd: DataFrame, group: str, valid_to: str = "_valid_to") -> DataFrame:
    """Latest end of validity per group."""
    return scd.groupBy(group).agg(F.max(valid_to).alias("last_seen"))


def scd2_merge(
    existing: DataFrame,
    current: DataFrame,
    key: str,
    attributes: Sequence[str],
    group: str,
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
    pass_closed: bool = True,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Extend the open interval of keys seen again, and add intervals for the rest.

    Per key, in order of `valid_from`, only the last two rows can be merged: when
    the earlier of them ends at the last load of its group, they become one row
    from the smaller start to the larger end. All other rows stay. A null
    attribute is a value like any other, and a group without an earlier load
    merges nothing. Running one snapshot twice changes nothing.

    A row that ends before the last load of its group cannot be merged as long as
    the intervals of a key do not overlap, which holds for all tables this
    function makes. Such rows, most of a long history, are passed on without a
    shuffle; `pass_closed=False` takes them into account for other tables.

    `seen` is a stored table of `group` and `last_seen`, if there is one (the manifest
    has the times of loads); else it is found by a pass over the two columns.

    The window is over one content key, which has at most one interval per load.
    """
    if seen is None:
        seen = stored(last_seen(existing, group, valid_to))
    seen = seen.select(F.col(group).alias("_group"), "last_seen")
    columns = [key, *attributes, valid_from, valid_to]

    def with_last_seen(df: DataFrame, source: int) -> DataFrame:
        return df.select(*columns, F.lit(source).alias("_source")).join(
            seen, F.col(group).eqNullSafe(F.col("_group")), "left"
        )

    before = with_last_seen(existing, 0)
    closed = F.coalesce(F.col(valid_to) < F.col("last_seen"), F.lit(False))
    rows = (before.filter(~closed) if pass_closed else before).unionByName(
        with_last_seen(current, 1)
    )
    newest_first = Window.partitionBy(key).orderBy(
        F.desc(valid_from), F.desc("_source"), F.desc(valid_to), *[F.desc(a) for a in attributes]
    )
    open_end = F.coalesce(F.col(valid_to) == F.col("last_seen"), F.lit(False))
    interval = F.when((F.col("_place") == 2) & open_end, 1).otherwise(F.col("_place"))
    merged = (
        rows.withColumn("_place", F.row_number().over(newest_first))
        .groupBy(key, *attributes, interval.alias("_interval"))
        .agg(F.min(valid_from).alias(valid_from), F.max(valid_to).alias(valid_to))
        .select(*columns)
    )
    return before.filter(closed).select(*columns).unionByName(merged) if pass_closed else merged
