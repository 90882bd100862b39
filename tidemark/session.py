"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Join skew is left to adaptive execution: a hot partition of a sort-merge join
# is split by map range, also where that costs one more exchange further up.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings the operators are designed for."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster is a cluster
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder and cut the lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_stored: list[str] = []


def stored(df: DataFrame) -> DataFrame:
    """Write once into the shared checkpoint folder and read from there.

    Lineage is cut like by a checkpoint, and Spark knows the size, so that joins
    with it are broadcast or not by Spark's own threshold. For reduced sides only.
    What was written goes when the program ends, or with `forget_stored`.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4()}"
    if not _stored:
        atexit.register(forget_stored)
    _stored.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_stored() -> None:
    """Remove what `stored` wrote; frames that read it can't be used any more."""
    spark = SparkSession.getActiveSession()
    while _stored and spark is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
