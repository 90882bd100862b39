"""Data-quality checks as one small table of failures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """Checks of one column, on the rows that satisfy `where`.

    `accepted` lists the allowed values; null fails only `not_null`.
    """

    column: str
    unique: bool = False
    not_null: bool = False
    accepted: Sequence | None = None
    where: Column | None = None


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Rows (column, rule, failures) for every requested rule.

    `unique` counts values that occur more than once, `not_null` rows, and
    `accepted_values` distinct values outside the list.

    Null counts of all columns are one aggregate without a shuffle of rows. Only the
    values that `unique` and `accepted_values` look at are grouped, those of all columns
    together, map-side first. So the table is scanned once for each of the two kinds,
    however many rules there are. Values are told apart by type and text; both zeros of
    a floating-point column are one value.
    """
    checks = list(checks)
    counted = [(i, c) for i, c in enumerate(checks) if c.not_null]
    valued = [(i, c) for i, c in enumerate(checks) if c.unique or c.accepted is not None]
    parts = []
    if counted:
        parts.append(_null_counts(df, counted))
    if valued:
        parts.append(_value_counts(df, valued))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, rule string, failures long")
    return reduce(DataFrame.unionByName, parts)


def _within(check: Check, condition: Column) -> Column:
    return condition if check.where is None else F.coalesce(check.where, F.lit(False)) & condition


def _null_counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    counts = df.agg(*[F.count_if(_within(c, F.col(c.column).isNull())).alias(f"n{i}") for i, c in checks])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.column).alias("column_name"), F.lit("not_null").alias("rule"),
                F.col(f"n{i}").cast("long").alias("failures"),
            )
            for i, c in checks
        ]
    )
    return counts.select(F.inline(rows))


def _value_counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    kinds = dict(df.dtypes)

    def told(check: Check) -> Column:
        value = F.col(check.column)
        if kinds.get(check.column) in ("float", "double"):
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)
        return F.when(_within(check, value.isNotNull()), value.cast("string"))

    def outside(check: Check) -> Column:
        return F.lit(False) if check.accepted is None else F.coalesce(~F.col(check.column).isin(*check.accepted), F.lit(False))

    values = F.array(
        *[F.struct(F.lit(i).alias("at"), told(c).alias("v"), outside(c).alias("outside")) for i, c in checks]
    )
    counts = (
        df.select(F.inline(F.filter(values, lambda x: x["v"].isNotNull())))
        .groupBy("at", "v", "outside")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    measured = {}
    for i, c in checks:
        if c.unique:
            measured[f"n{i}u"] = (c.column, "unique", F.count_if((F.col("at") == i) & (F.col("n") > 1)))
        if c.accepted is not None:
            measured[f"n{i}a"] = (c.column, "accepted_values", F.count_if((F.col("at") == i) & F.col("outside")))
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
                F.col(n).cast("long").alias("failures"),
            )
            for n, (column, rule, _) in measured.items()
        ]
    )
    return counts.agg(*[count.alias(n) for n, (_, _, count) in measured.items()]).select(F.inline(rows))
