"""Parent/child trees kept as one row per node."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

CHUNK = 1_000  # children joined to one string at a time


def walk_hierarchy(
    edges: DataFrame,
    roots: DataFrame,
    parent: str,
    child: str,
    ordinal: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """All nodes reached from the roots, with parent, depth and path.

    `roots` has one column, the root nodes. A node with several parents appears
    once per path; a path that would meet itself ends. With `ordinal`, the place
    of a child among its siblings, `trail` lists those places from the root on;
    its order is depth first. `carry` adds columns of the edge that led to the
    node.

    One join per level, each level cut off by a checkpoint, so the number of jobs
    is the depth of the tree. Edges are stored once in the warehouse, in buckets by
    parent, and each level shuffles (or broadcasts, if Spark finds it small) the nodes
    it has reached only; the stored edges are dropped at the end.
    """
    carried = {c: f"_carry{i}" for i, c in enumerate(carry)}
    links = edges.select(
        F.col(parent).alias("_parent"),
        F.col(child).alias("_child"),
        *([] if ordinal is None else [F.col(ordinal).cast("long").alias("_place")]),
        *[F.col(c).alias(n) for c, n in carried.items()],
    )
    start = roots.columns[0]
    node = F.col(start)
    level = roots.select(
        node.alias("node"),
        F.lit(None).cast(roots.schema[start].dataType).alias("parent"),
        F.lit(0).alias("depth"),
        F.array(node).alias("path"),
        *([] if ordinal is None else [F.array().cast("array<bigint>").alias("trail")]),
        *[F.lit(None).cast(links.schema[n].dataType).alias(c) for c, n in carried.items()],
    )
    levels = [level]
    with bucketed(links, "_parent") as stored_links:
        while True:
            level = materialise(_children(level.drop(*carry), stored_links, ordinal is not None, carried))
            if level.isEmpty():
                return reduce(DataFrame.unionByName, levels)
            levels.append(level)


@contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """The rows stored in the warehouse by `key`, as long as the block lasts."""
    spark = df.sparkSession
    name = f"tidemark_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"drop table if exists {name}")


def _children(level: DataFrame, links: DataFrame, placed: bool, carried: Mapping[str, str]) -> DataFrame:
    """The level below, without the ways that would meet themselves."""
    reached = level.join(links, F.col("node") == F.col("_parent"))
    return reached.filter(~F.array_contains("path", F.col("_child"))).select(
        F.col("_child").alias("node"),
        F.col("node").alias("parent"),
        (F.col("depth") + 1).alias("depth"),
        F.array_append("path", F.col("_child")).alias("path"),
        *([F.array_append("trail", F.col("_place")).alias("trail")] if placed else []),
        *[F.col(n).alias(c) for c, n in carried.items()],
    )


def flatten_hierarchy(
    nodes: DataFrame,
    key: str = "key",
    parent: str = "parent",
    name: str = "name",
    link: str = "link",
    ordinal: str = "ordinal",
) -> DataFrame:
    """One row per node: parent name, name, link, and the children joined by ', '.

    Leaves have ''. The children of a node are joined in runs of `CHUNK`
    ordinals, and the runs then put together, so no task sorts them all.
    """

    def joined(order: str, text: str):
        pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text))))
        return F.array_join(F.transform(pairs, lambda pair: pair[text]), ", ")

    children = (
        nodes.filter(F.col(parent).isNotNull())
        .groupBy(F.col(parent).alias("_of"), F.floor(F.col(ordinal) / CHUNK).alias("_run"))
        .agg(joined(ordinal, name).alias("_text"))
        .groupBy("_of")
        .agg(joined("_run", "_text").alias("_children"))
    )
    parents = nodes.select(F.col(key).alias("_key"), F.col(name).alias("_parent_name"))
    return (
        nodes.join(parents, F.col(parent) == F.col("_key"), "left")
        .join(children, F.col(key) == F.col("_of"), "left")
        .select(
            F.col("_parent_name").alias("parent_name"),
            F.col(name).alias("department_name"),
            F.col(link).alias("department_link"),
            F.coalesce("_children", F.lit("")).alias("children"),
        )
    )
