"""Interval tables in an open and a closed part.

A row is open while a later load can still extend it, that is while it ends at the last
load of its group. Every version adds the rows that it closed and holds the open ones
anew, so a load reads and writes the open part alone, whatever the length of the
history. The last load of each group is stored beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd2 import last_seen, scd2_merge
from tidemark.sources import versions

RETRIES = 20  # of a merge that another writer's came before


def _write(
    rows: DataFrame, seen: DataFrame, path: str, group: str, valid_to: str, expected: int
) -> int:
    """Write rows by their part, open or closed under the last loads, and commit them."""
    spark, content = rows.sparkSession, versions.new_content(path)
    seen.write.parquet(f"{content}/seen")
    stored = spark.read.schema(seen.schema).parquet(f"{content}/seen").select(
        F.col(group).alias("_tm_group"), F.col("last_seen").alias("_tm_seen")
    )
    closed = F.coalesce(F.col(valid_to) < F.col("_tm_seen"), F.lit(False))
    rows.join(stored, F.col(group).eqNullSafe(F.col("_tm_group")), "left").select(
        *rows.columns, F.when(closed, "closed").otherwise("open").alias("_tm_part")
    ).write.partitionBy("_tm_part").parquet(f"{content}/rows")
    return versions.commit(spark, path, content, expected)


def store_intervals(
    history: DataFrame, path: str, group: str, valid_to: str = "_valid_to"
) -> int:
    """Make a whole history the first version of an interval table; returns its number.

    Raises `ConcurrentChange` where there is one.
    """
    return _write(history, last_seen(history, group, valid_to), path, group, valid_to, 0)


def _part(spark: SparkSession, contents: Sequence[str], part: str, schema: T.StructType) -> DataFrame:
    folders = [f"{c}/rows/_tm_part={part}" for c in contents]
    there = [f for f in folders if versions.exists(spark, f)]
    return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)


def _schema(spark: SparkSession, content: str) -> T.StructType:
    fields = spark.read.parquet(f"{content}/rows").schema
    return T.StructType([f for f in fields if f.name != "_tm_part"])


def read_intervals(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All intervals of a version, the newest unless given."""
    known = versions.committed(spark, path)
    version = version or max(known, default=None)
    if version not in known:
        raise FileNotFoundError(f"{path}, version {version}")
    contents = [folder for n, folder in known.items() if n <= version]
    schema = _schema(spark, contents[-1])
    return _part(spark, contents[-1:], "open", schema).unionByName(_part(spark, contents, "closed", schema))


def merged_open(
    spark: SparkSession, content: str, current: DataFrame, key: str, attributes: Sequence[str], group: str,
    valid_from: str = "_valid_from", valid_to: str = "_valid_to",
) -> tuple[DataFrame, DataFrame]:
    """The open part of a content with a load merged in, and the last loads after it."""
    rows = _part(spark, [content], "open", _schema(spark, content))
    before = spark.read.parquet(f"{content}/seen")
    after = before.unionByName(last_seen(current, group, valid_to)).groupBy(group).agg(F.max("last_seen").alias("last_seen"))
    merged = scd2_merge(
        rows, current, key, attributes, group, valid_from, valid_to, pass_closed=False, seen=before
    )
    return merged, after


def merge_into(
    path: str,
    current: DataFrame,
    key: str,
    attributes: Sequence[str],
    group: str,
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> int:
    """Merge a load into an interval table, by the rules of `scd2_merge`.

    Returns the number of the new version. Without a version, the load is the first. A
    repeated load changes nothing. Of loads merged at the same time each sees the
    others': one that another came before is merged anew.

    Rows closed by earlier versions are neither read nor written. Intervals of a key
    must not overlap, which holds for all tables made this way; null keys of groups and
    attributes are values like any other.
    """
    spark = current.sparkSession
    for _ in range(RETRIES):
        known = versions.committed(spark, path)
        if not known:
            first = current.select(key, *attributes, valid_from, valid_to)
            rows, seen, last = first, last_seen(current, group, valid_to), 0
        else:
            last = max(known)
            rows, seen = merged_open(spark, known[last], current, key, attributes, group, valid_from, valid_to)
        try:
            return _write(rows, seen, path, group, valid_to, last)
        except versions.ConcurrentChange:
            continue
    raise versions.ConcurrentChange(f"{path}: other writers came first {RETRIES} times")
