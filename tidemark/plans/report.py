"""The summary report as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.functions.measures import band
from tidemark.operators.summary import (
    breakdown, category_counts, completeness, headcount, pivot_counts, rollup_renamed,
    split_by_membership,
)


def report_tables(
    facts: DataFrame,
    dim: DataFrame,
    entity: str,
    group: str,
    categories: Mapping[str, Sequence[str | None]],
    rules: Mapping,
    renamed: Mapping[str, str],
    apart: Sequence[str],
) -> dict[str, DataFrame]:
    """Overall counts, completeness with bands, and per-group matrices and headcounts.

    `categories` gives the columns to break down by and, for each, the values that
    are the columns of its matrix. Groups in `apart` get tables of their own, renamed groups are added up first.
    """
    out = {"completeness": completeness(dim, rules).withColumn("band", band("pct"))}
    heads = rollup_renamed(headcount(facts, entity, group), group, renamed, count="headcount")
    out["headcount"], out["headcount_apart"] = split_by_membership(heads, group, apart)
    for category, values in categories.items():
        out[category] = category_counts(dim, category)
        counts = breakdown(facts, dim, entity, group, category)
        counts = rollup_renamed(counts, group, renamed, by=[category])
        inside, outside = split_by_membership(counts, group, apart)
        out[f"{category}_by_group"] = pivot_counts(inside, group, category, values)
        out[f"{category}_by_group_apart"] = pivot_counts(outside, group, category, values)
    return out
