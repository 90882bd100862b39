"""Load sessions: runs of timestamps without a long gap."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import elapsed_seconds
from tidemark.functions.keys import content_key
from tidemark.operators.scale import skew_join
from tidemark.session import stored

DAY = 86_400
STRETCH = 4_096  # slots that one window numbers


def _slot(ts: Column, seconds: int) -> Column:
    """Number of the time slot of the given length that holds the timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, ts)
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


def gap_sessions(
    df: DataFrame,
    ts: str,
    threshold_days: float = 0.7,
    partition: Sequence[str] = (),
    round_days: int = 2,
) -> DataFrame:
    """Sessions split where the gap in days, rounded, exceeds the threshold.

    Per session: its number by start, start, end, and duration in hours.

    Timestamps less than the shortest breaking gap apart never part, so they are
    first reduced to the earliest and latest per slot of that length, map-side.
    Windows then run over stretches of `STRETCH` slots, and over the first and last
    of each stretch; so no task sees all slots, even without a partition column.
    """
    half_unit = 0.5 * 10**-round_days
    width = max(1, math.floor((threshold_days - half_unit) * DAY) - 1)
    slots = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*partition, _slot(F.col(ts), width).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )

    def breaks(last: Column, first: Column) -> Column:
        gap = F.round(elapsed_seconds(last, first) / F.lit(DAY), round_days)
        return F.coalesce((gap > threshold_days).cast("int"), F.lit(0))

    inside = Window.partitionBy(*partition, "_stretch").orderBy("_slot")
    cut = (
        slots.withColumn("_stretch", F.floor(F.col("_slot") / STRETCH))
        .withColumn("_breaks", breaks(F.lag("_last").over(inside), F.col("_first")))
        .withColumn("_before", F.sum("_breaks").over(inside))
    )
    along = Window.partitionBy(*[f"_of_{p}" for p in partition]).orderBy("_of_stretch")
    starts = (
        cut.groupBy(*[F.col(p).alias(f"_of_{p}") for p in partition], F.col("_stretch").alias("_of_stretch"))
        .agg(F.min("_first").alias("_from"), F.max("_last").alias("_to"), F.sum("_breaks").alias("_inside"))
        .withColumn("_broken", breaks(F.lag("_to").over(along), F.col("_from")))
        .withColumn("_earlier", F.sum(F.col("_broken") + F.col("_inside")).over(along) - F.col("_inside"))
        .drop("_from", "_to", "_inside", "_broken")
    )
    on = [(p, f"_of_{p}") for p in partition] + [("_stretch", "_of_stretch")]
    numbered = skew_join(cut, starts, on, "inner").withColumn(
        "session_id", F.col("_earlier") + F.col("_before") + 1
    )
    hours = elapsed_seconds(F.col("session_start"), F.col("session_end")) / F.lit(3600)
    return (
        numbered.groupBy(*partition, "session_id")
        .agg(F.min("_first").alias("session_start"), F.max("_last").alias("session_end"))
        .withColumn("session_duration_hours", F.round(hours, 5))
    )


def assign_session(
    df: DataFrame,
    sessions: DataFrame,
    ts: str,
    partition: Sequence[str] = (),
) -> DataFrame:
    """Add the id of the session whose start and end enclose the timestamp.

    Rows outside all sessions keep null; null partitions match null ones. Sessions
    of a partition must not overlap, as those of `gap_sessions` don't.

    Distinct timestamps and the starts of sessions are laid in one order and cut into
    pieces of equal size by it, wherever that cuts a partition or a day. Inside a piece
    the last start before a timestamp is carried forward; what a piece ends with is
    carried on to the next pieces of its partition, of which there is one row each. So
    no task depends on how many timestamps a day or a partition has. The pieces are
    written once, as both steps must see the same ones. Rows get their timestamp's
    session by a join whose hot keys adaptive execution can split.
    """
    keys = [f"_of_{p}" for p in partition]
    listed = sessions.select(
        *[F.col(p).alias(k) for p, k in zip(partition, keys, strict=True)],
        F.col("session_start").alias("_at"),
        F.struct("session_id", "session_end").alias("_session"),
    )
    times = (
        df.filter(F.col(ts).isNotNull())
        .select(*[F.col(p).alias(k) for p, k in zip(partition, keys, strict=True)], F.col(ts).alias("_at"))
        .distinct()
    )
    pieces = stored(
        listed.unionByName(times, allowMissingColumns=True)
        .repartitionByRange(*keys, "_at")
        .withColumn("_piece", F.spark_partition_id())
    )
    in_time = Window.partitionBy(*keys, "_piece").orderBy("_at", F.col("_session").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*[f"_in{k}" for k in keys]).orderBy("_in_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ends = pieces.groupBy(*[F.col(k).alias(f"_in{k}") for k in keys], F.col("_piece").alias("_in_piece")).agg(
        F.max_by("_session", F.when(F.col("_session").isNotNull(), F.col("_at"))).alias("_end")
    )
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    inside = pieces.withColumn("_last", F.last("_session", ignorenulls=True).over(in_time)).filter("_session is null")
    on = [*[(k, f"_in{k}") for k in keys], ("_piece", "_in_piece")]
    last = F.coalesce("_last", "_carried")
    found = (
        skew_join(inside, carried, on, "left")
        .select(
            *keys, F.col("_at").alias("_of_ts"),
            F.when(F.col("_at") <= last["session_end"], last["session_id"]).alias("session_id"),
        )
        .filter("session_id is not null")
    )
    plain = df.drop("session_id") if "session_id" in df.columns else df
    joined = skew_join(plain, found, [*zip(partition, keys, strict=True), (ts, "_of_ts")], "left")
    return joined.select(*plain.columns, "session_id")


def load_history(
    manifest: DataFrame,
    sessions: DataFrame,
    ts: str = "_accessed_at",
    group: str = "group_name",
    table: str = "table_name",
) -> DataFrame:
    """The manifest with session number and a composite id, in order of time.

    Rows of one time are ordered by group, table and the other columns, and so dealt to
    several tasks however many there are.
    """
    return (
        assign_session(manifest, sessions, ts)
        .withColumn("metadata_id", content_key("session_id", group, table))
        .orderBy(ts, group, table, *[c for c in manifest.columns if c not in (ts, group, table)])
    )
