"""Summaries: shares, breakdowns, completeness, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import share


def share_of_total(df: DataFrame, category: str) -> DataFrame:
    """Rows per category and their percentage of all rows, null being a category.

    The total is a scalar subquery over the counts, not a window in one task.
    """
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.select(
        category, "count", F.round(F.col("count").cast("double") * 100 / total, 2).alias("pct")
    )


def category_counts(df: DataFrame, category: str, unknown: str = "Unknown") -> DataFrame:
    """Rows per category, the most frequent first, then by name; null is shown as `unknown`.

    A literal `unknown` stays a group of its own, apart from the nulls.
    """
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(F.coalesce(category, F.lit(unknown)).alias(category), "count").orderBy(
        F.desc("count"), category
    )


def breakdown(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    group: str,
    category: str,
    unknown: str = "Unknown",
) -> DataFrame:
    """Distinct entities per group and category; facts without a group are left out."""
    joined = facts.filter(F.col(group).isNotNull()).select(on, group).distinct().join(
        dim.select(on, category), on
    )
    return (
        joined.groupBy(group, category)
        .agg(F.count_distinct(on).alias("count"))
        .withColumn(category, F.coalesce(category, F.lit(unknown)))
    )


def headcount(facts: DataFrame, entity: str, group: str) -> DataFrame:
    """Distinct entities per group, the largest first, then by name."""
    return (
        facts.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count_distinct(entity).alias("headcount"))
        .orderBy(F.desc("headcount"), group)
    )


def completeness(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule, the rows that satisfy it, all rows, and the percentage to one decimal.

    All rules are counted in one pass. Halves round to the even digit.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(f"_{i}").alias("count"))
            for i, name in enumerate(rules)
        ]
    )
    return counted.select("total", F.inline(pairs)).withColumn(
        "pct", F.bround(share(F.col("count"), F.col("total")), 1)
    )


def current_name(group: str, renamed: Mapping[str, str]) -> Column:
    """The group's present name."""
    if not renamed:
        return F.col(group)
    names = F.create_map(*[F.lit(x) for pair in renamed.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.col(group)), F.col(group))


def rollup_renamed(
    df: DataFrame,
    group: str,
    renamed: Mapping[str, str],
    by: Sequence[str] = (),
    count: str = "count",
    entity: str | None = None,
) -> DataFrame:
    """Counts under the present names of renamed groups.

    Without `entity`, `df` holds counts and these are added up, so an entity in
    both the old and the new group counts twice. With `entity`, `df` holds facts
    and distinct entities are counted.
    """
    rows = df.withColumn(group, current_name(group, renamed)).groupBy(group, *by)
    return rows.agg((F.count_distinct(entity) if entity else F.sum(count)).alias(count))


def pivot_counts(
    df: DataFrame,
    row: str,
    category: str,
    categories: Sequence[str | None],
    count: str = "count",
) -> DataFrame:
    """Matrix of rows by the given categories, in their order; a missing cell is 0.

    The columns are the caller's, so the result has a schema without looking at
    data. A null category is the column `null`. Others than those given are left out.
    """
    wide = df.groupBy(row).pivot(category, list(categories)).agg(F.sum(count))
    return wide.na.fill(0, [c for c in wide.columns if c != row]).orderBy(row)


def cell_counts(df: DataFrame, row: str, category: str, count: str = "count") -> DataFrame:
    """The long form of a matrix whose categories are not known: row, category, count."""
    return df.groupBy(row, category).agg(F.sum(count).alias(count)).orderBy(row, category)


def split_by_membership(
    df: DataFrame, col: str, members: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows outside the list (null included), and the rows in it."""
    inside = F.coalesce(F.col(col).isin(*members), F.lit(False))
    return df.filter(~inside), df.filter(inside)


def row_percent(wide: DataFrame, row: str, categories: Sequence[str] | None = None) -> DataFrame:
    """A pivot as percentages of each row's total, 0 where the total is 0."""
    categories = [c for c in wide.columns if c != row] if categories is None else list(categories)
    total = sum((F.col(c) for c in categories), F.lit(0))
    return wide.select(row, *[share(F.col(c), total).alias(c) for c in categories])


def sample_unlabelled(
    df: DataFrame,
    name: str,
    label: str,
    unlabelled: str = "Unknown",
    placeholders: Sequence[str] = (),
    min_length: int = 4,
    n: int = 300,
) -> DataFrame:
    """The first `n` names, in order, that got no label and look like names."""
    return (
        df.filter(
            (F.col(label) == unlabelled)
            & ~F.col(name).isin(*placeholders)
            & (F.length(name) >= min_length)
        )
        .select(name)
        .orderBy(name)
        .limit(n)
    )
