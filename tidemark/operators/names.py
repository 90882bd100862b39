"""Standardised names: the mapping, its use, and the history of attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.titles import leading_title, strip_affixes, trailing_suffix
from tidemark.operators.scale import skew_join


def split_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Add `prefix`, `postfix` and the `extracted_name` left between them.

    Title and honours pass through a generator: later filters on them cannot be
    moved below it, which would repeat the pattern search for every mention.
    """
    found = F.struct(
        leading_title(name).alias("prefix"), trailing_suffix(name).alias("postfix")
    )
    return df.select("*", F.inline(F.array(found))).withColumn(
        "extracted_name", strip_affixes(name, "prefix", "postfix")
    )


def build_name_mapping(
    df: DataFrame, columns: Sequence[str] = ("extracted_name", "name", "email")
) -> DataFrame:
    """The distinct combinations of cleaned name, raw name and contact."""
    return df.select(*columns).distinct()


def attribute_history(
    df: DataFrame,
    keys: Sequence[str],
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> DataFrame:
    """First and last validity per combination of keys; a null key drops the row."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.min(valid_from).alias("effective_from"), F.max(valid_to).alias("effective_to"))
    )


def canonicalise(
    df: DataFrame,
    mapping: DataFrame,
    raw: str,
    mapping_raw: str,
    mapping_canonical: str,
    name: str = "canonical_name",
    fallback: bool = True,
    empty_is_missing: bool = True,
) -> DataFrame:
    """Add the mapped name of `raw`; with `fallback`, `raw` itself where it has none.

    An empty mapped name then counts as none, unless `empty_is_missing` is off.
    Without `fallback` an unmapped row gets null. The mapping is reduced to its
    distinct pairs first, so that it does not multiply rows. It grows with the
    data and is therefore not broadcast by hint.
    """
    pairs = (
        mapping.filter(F.col(mapping_raw).isNotNull())
        .select(F.col(mapping_raw).alias("_raw"), F.col(mapping_canonical).alias("_mapped"))
        .distinct()
    )
    joined = skew_join(df, pairs, [(raw, "_raw")], "left")
    mapped = F.col("_mapped")
    if fallback:
        given = F.nullif(mapped, F.lit("")) if empty_is_missing else mapped
        mapped = F.coalesce(given, F.col(raw))
    return joined.withColumn(name, mapped).drop("_raw", "_mapped")
