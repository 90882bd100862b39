"""Stand-ins for directory snapshots, derived from the driver's tables.

Every builder has its SQL twin in `checks.oracles`, under the same name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession) -> str:
    """A new folder name inside the session's checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations: an order is a customer seen in a position and a unit on a date."""
    orders = load(spark, sf_dir, "orders")
    first_part = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_partkey").alias("p_partkey"))
    )
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (
        orders.join(first_part, "o_orderkey")
        .join(part, "p_partkey")
        .select(
            F.col("o_custkey").cast("string").alias("entity"),
            F.col("p_name").alias("name"),
            F.col("o_orderpriority").alias("position"),
            F.col("p_type").alias("unit"),
            F.col("o_orderstatus").alias("grp"),
            F.to_date("o_orderdate").alias("observed"),
            F.col("o_orderkey").alias("seq"),
        )
    )


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments whose names carry titles and honours in twelve forms."""
    form = F.col("seq") % 12
    name = F.col("name")
    shapes = [
        ("Dr. ", ""), ("Assoc Prof ", " PBM"), ("Prof. Adj. Prof ", ", PPA (E)"), ("MDM  ", ""),
        ("  Mr ", " "), ("Sir ", ""), ("x (Ret) ", " PK, BBM"), ("Adj A/Prof. ", "CRM"),
        ("Supt(1A) ", " P. Kepujian"), ("Justice ", ","), ("Clin A/P (Dr) ", " PB"),
    ]
    raw = F.when(form == 11, F.upper(name))
    for i, (before, after) in enumerate(shapes):
        raw = raw.when(form == i, F.concat(F.lit(before), name, F.lit(after)))
    return assignments(spark, sf_dir).withColumn("raw", raw)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments with a contact per entity, some of them of a post, in mixed case."""
    form = F.col("entity").cast("long") % 40
    e = F.col("entity")
    contact = (
        F.when(form == 0, F.concat(F.lit("Enquiry"), e, F.lit("@Desk")))
        .when(form == 1, F.concat(F.lit("http://desk/"), e))
        .when(form == 2, F.concat(F.lit("Director@"), e))
        .when(form == 3, F.concat(F.lit("unit_QSM@"), e))
        .when(form == 4, F.concat(F.lit("d-"), e))
        .when(F.col("seq") % 2 == 0, F.concat(F.lit("Person"), e, F.lit("@desk")))
        .otherwise(F.concat(F.lit("person"), e, F.lit("@desk")))
    )
    return assignments(spark, sf_dir).withColumn("contact", contact)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw to cleaned names, a row per supplier brand: some repeated, some '', some absent."""
    part = load(spark, sf_dir, "part")
    name = F.col("p_name")
    cleaned = (
        F.when(name.startswith("blue"), "")
        .when(name.startswith("large"), F.concat(F.lit("Large "), F.get(F.split(name, " "), 1)))
        .otherwise(F.upper(name))
    )
    return part.filter(~name.startswith("red")).select(
        name.alias("raw"), cleaned.alias("cleaned"), F.col("p_brand").alias("email")
    )


def title_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity and first word of its names: from, to, and whether it is the latest."""
    rows = assignments(spark, sf_dir).withColumn("title", F.get(F.split("name", " "), 0))
    return rows.groupBy("entity", "title").agg(
        F.min("observed").alias("effective_from"), F.max("observed").alias("effective_to")
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots on the first of each month; one unit is null."""
    return assignments(spark, sf_dir).select(
        "name", "position", F.nullif("unit", F.lit("ECONOMY")).alias("unit"), "grp",
        F.date_trunc("month", "observed").cast("timestamp_ntz").alias("month"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of regions, nations and customers, a row per node."""

    def level(table: str, mark: str, key: str, name: str, up: str | None, up_mark: str = ""):
        parent = F.lit(None).cast("string") if up is None else F.concat(
            F.lit(up_mark), F.col(up).cast("string")
        )
        node = F.concat(F.lit(mark), F.col(key).cast("string"))
        return load(spark, sf_dir, table).select(
            node.alias("key"), parent.alias("parent"), F.col(name).alias("name"),
            F.concat(F.lit("/"), node).alias("link"), F.col(key).cast("long").alias("ordinal"),
        )

    return (
        level("region", "R", "r_regionkey", "r_name", None)
        .unionByName(level("nation", "N", "n_nationkey", "n_name", "n_regionkey", "R"))
        .unionByName(level("customer", "C", "c_custkey", "c_name", "c_nationkey", "N"))
    )


def shared_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entities, the part and supplier they ordered as values."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias(
            "value"
        ),
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, "o_orderkey").select(
        F.col("o_custkey").alias("entity"), "value", F.to_date("o_orderdate").alias("observed")
    )
