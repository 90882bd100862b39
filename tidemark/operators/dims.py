"""Dimensions: one row per entity, one row per unit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.operators.scale import with_group_max


def entity_dim(
    names: DataFrame,
    name: str,
    attributes: Sequence[DataFrame] = (),
    defaults: Mapping[str, object] | None = None,
    key: str = "entity_key",
) -> DataFrame:
    """Distinct non-null names with a surrogate key and the attributes joined by name.

    Every attribute table must have unique names, or the dimension has not.
    `defaults` replaces nulls of columns, such as a flag that is false if absent.
    """
    out = names.select(name).filter(F.col(name).isNotNull()).distinct()
    for table in attributes:
        out = out.join(table, name, "left")
    out = out.withColumn(key, surrogate_key(name))
    for col, value in (defaults or {}).items():
        out = out.withColumn(col, F.coalesce(col, F.lit(value)))
    return out.select(key, *[c for c in out.columns if c != key])


def unit_dim(
    df: DataFrame,
    name: str,
    parent: str,
    group: str,
    url: str,
    ts: str,
) -> DataFrame:
    """Per parent, group and url: the last name, all names, first and last time seen.

    A unit is active when it was seen in the last load of its group, which is
    read off the already reduced units.
    """
    units = df.groupBy(parent, group, url).agg(
        F.max_by(name, F.struct(ts, name)).alias("latest_name"),
        F.sort_array(F.collect_set(name)).alias("names"),
        F.min(ts).alias("effective_from"),
        F.max(ts).alias("effective_to"),
    )
    return (
        with_group_max(units, "effective_to", [group], "_last_load")
        .withColumn("count_names", F.size("names"))
        .withColumn("is_active", F.col("effective_to") == F.col("_last_load"))
        .drop("_last_load")
    )
