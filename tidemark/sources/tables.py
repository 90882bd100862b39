"""Tables on shared storage: loads, whole replacement, and rule files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import versions

RULES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("label", "kind", "pattern", "notes")]
)


def append_table(
    df: DataFrame,
    path: str,
    ts: str = "_accessed_at",
    day: str = "snapshot_date",
    group: str = "group_name",
    load: str = "load_id",
) -> None:
    """Append stamped loads to the raw table, partitioned by date and load.

    A load is what has one group and one time, and comes in one call. It is the unit of
    commit: if it is there already, after a lost or repeated run, its partition is
    replaced, and other loads are left alone. Readers that filter on the date read only
    those folders. Null groups and times are values like any other. A table without the
    group column has one load per time.
    """
    of = [c for c in (group, ts) if c in df.columns]
    told = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in of]), {"ignoreNullFields": "false"})
    loads = df.withColumns({day: F.to_date(ts), load: F.concat(F.lit("load-"), F.md5(told))})
    loads.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, load).parquet(path)


def replace_table(df: DataFrame, path: str, expected: int | None = None, keep: int | None = None) -> int:
    """Write `df` as the whole new content of the table; returns its version.

    Every content gets a folder of its own and counts once it is committed. So `df` may
    read the table it replaces, and readers keep the old content until then. Writers at
    the same time get a version each, and the last one is current; with `expected`, the
    version that `df` was made from (0 for none), a writer that another came before gets
    `ConcurrentChange` instead. `keep` removes all but the last versions afterwards.
    """
    spark, content = df.sparkSession, versions.new_content(path)
    df.write.parquet(content)
    version = versions.commit(spark, path, content, expected)
    if keep is not None:
        versions.drop_old(spark, path, max(keep, 1))
    return version


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest content of a replaced table, or the given version."""
    known = versions.committed(spark, path)
    version = version or max(known, default=None)
    if version not in known:
        raise FileNotFoundError(f"{path}, version {version}")
    return spark.read.parquet(known[version])


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A parquet table, or some of its columns."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules for `rule_cascade` from CSV files with a header line."""
    return spark.read.schema(RULES).option("header", True).csv(path)
