"""Values of entities: shared, private, and shared by exactly n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shared_values(df: DataFrame, entity: str, value: str) -> DataFrame:
    """Values used by more than one entity, with the number of entities."""
    return (
        df.groupBy(value)
        .agg(F.count_distinct(entity).alias("entity_count"))
        .filter(F.col("entity_count") > 1)
    )


def latest_private_value(
    df: DataFrame, entity: str, value: str, observed: str
) -> DataFrame:
    """Per entity, its most recent value that no other entity uses.

    A value is private exactly when its smallest and largest entity agree, so
    two aggregates do; neither an anti-join nor a window is needed. Equal times
    go by the value. Rows without an entity or a value are left out.
    """
    owners = (
        df.dropna(subset=[entity, value])
        .groupBy(value)
        .agg(
            F.min(entity).alias(entity),
            F.max(entity).alias("_other"),
            F.max(observed).alias("_seen"),
        )
        .filter(F.col(entity) == F.col("_other"))
    )
    best = F.max(F.struct("_seen", value)).alias("_best")
    return owners.groupBy(entity).agg(best).select(
        entity,
        F.col(f"_best.{value}").alias(value),
        F.col("_best._seen").alias(observed),
        F.lit(True).alias("has_private_value"),
    )


def possible_duplicates(df: DataFrame, entity: str, value: str, n: int = 2) -> DataFrame:
    """Values shared by exactly `n` entities, with the sorted entities.

    More than `n` rules a value out, so at most `n + 1` entities of a value leave
    a task: the limit on the row number is applied before the shuffle too.
    """
    in_order = Window.partitionBy(value).orderBy(entity)
    return (
        df.select(value, entity)
        .dropna()
        .distinct()
        .withColumn("_nth", F.row_number().over(in_order))
        .filter(F.col("_nth") <= n + 1)
        .groupBy(value)
        .agg(
            F.count(F.lit(1)).alias("entity_count"),
            F.sort_array(F.collect_list(entity)).alias("entities"),
        )
        .filter(F.col("entity_count") == n)
    )
