"""Staging: rename, flag the latest rows, drop placeholders, keep the longest."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scale import with_group_max


def project_rename(
    df: DataFrame, spec: Sequence[str] | Mapping[str, str], view: str | None = None
) -> DataFrame:
    """Pick columns, renaming old -> new where a mapping is given; optionally as a view."""
    pairs = spec.items() if isinstance(spec, Mapping) else [(c, c) for c in spec]
    out = df.select(*[F.col(old).alias(new) for old, new in pairs])
    if view is not None:
        out.createOrReplaceTempView(view)
    return out


def flag_latest(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    name: str = "is_latest",
    few_groups: bool = True,
) -> DataFrame:
    """Mark the rows that hold the largest `value` of their group."""
    return (
        with_group_max(df, value, partition, "_peak", few_groups)
        .withColumn(name, F.col(value) == F.col("_peak"))
        .drop("_peak")
    )


def keep_longest(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """One row per key: the longest `col`, then the one that sorts first.

    Remaining ties, which differ in other columns only, go by those columns.
    An aggregate and not a window, so a hot key is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in (*keys, col)]
    first = F.struct(-F.coalesce(F.length(col), F.lit(-1)), col, *rest)
    row = F.min(first).alias("_row")
    return df.groupBy(*keys).agg(row).select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])


def drop_sentinels(df: DataFrame, sentinels: Mapping[str, Iterable[str]]) -> DataFrame:
    """Keep rows whose listed columns are neither null nor one of the placeholders."""
    for col, values in sentinels.items():
        df = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
    return df
