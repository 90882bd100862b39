"""Append loads to the raw table as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving_loads(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    group: str,
    group_col: str = "group_name",
    ts_col: str = "_accessed_at",
) -> DataFrame:
    """Rows of the parquet files put into `folder/load=<time>/`, stamped with group and time.

    A delivery has one time, that of its folder, such as `load=2024-05-07 10:30:00`
    (also percent-encoded, as Spark writes it). So it stays one load in the manifest
    and for the interval merge, in however many batches its files are read. A file in
    no such folder, or with a time that can't be read, fails the query.
    """
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    path = F.col("_metadata.file_path")
    named = F.url_decode(F.regexp_replace(F.regexp_extract(path, r"/load=([^/]+)/[^/]+$", 1), r"\+", "%2B"))
    # file paths are themselves encoded, so a folder that Spark named is encoded twice
    text = F.regexp_replace(F.url_decode(F.regexp_replace(named, r"\+", "%2B")), "T", " ")
    time = F.try_to_timestamp(text).cast("timestamp_ntz")
    failed = F.raise_error(F.concat(F.lit("no load=<time> folder: "), path)).cast("timestamp_ntz")
    return rows.withColumns({group_col: F.lit(group), ts_col: F.coalesce(time, failed)})


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "_accessed_at",
    day: str = "snapshot_date",
    interval: str | None = None,
) -> StreamingQuery:
    """Append a stream of stamped rows to the raw table, each file once.

    Without `interval`, what is there is loaded and the query ends.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        rows.withColumn(day, F.to_date(ts))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(day)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
