"""From pages to snapshot tables, and from snapshots to interval and name tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import remap_dates
from tidemark.functions.keys import content_key
from tidemark.operators.dims import entity_dim
from tidemark.operators.hierarchy import flatten_hierarchy, walk_hierarchy
from tidemark.operators.names import attribute_history, build_name_mapping, split_names
from tidemark.operators.scd2 import scd2_merge
from tidemark.operators.snapshots import latest_snapshot, load_manifest, stamp_snapshot
from tidemark.operators.staging import flag_latest, keep_longest
from tidemark.session import materialise
from tidemark.sources.pages import extract_page_links, extract_page_records


def snapshot_tables(
    pages: DataFrame,
    root: str | DataFrame,
    group: str,
    observed_at: dt.datetime,
    seconds: float | None = None,
    lists: Mapping | None = None,
    records: Mapping | None = None,
) -> dict[str, DataFrame]:
    """People, units and manifest of one load, from fetched pages (url, html).

    Units are reached from the page `root`, or from several (a frame whose column is
    `link`), which stand for the group itself; a unit listed on several pages appears
    under each of them, people included. A unit whose page is missing has no people and
    no units below it. `seconds` is how long fetching took. `lists` and `records` tell
    where pages list units and people, as options of `extract_page_links` and
    `extract_page_records`; people need the fields position, name and email.
    """
    spark = pages.sparkSession
    links = extract_page_links(pages, parent="url", **(lists or {})).filter(F.col("link").isNotNull())
    start = spark.range(1).select(F.lit(root).alias("link")) if isinstance(root, str) else root.select("link").distinct()
    walk = walk_hierarchy(materialise(links), start, "parent", "link", "ordinal", ["name"])
    places = F.col("trail")
    way = F.concat(F.slice("path", 1, 1), F.transform(places, lambda p: p.cast("string")))  # the root, then places
    nodes = walk.select(
        F.array_join(way, "/").alias("key"),
        F.when(F.size(places) > 0, F.array_join(F.slice(way, 1, F.size(places)), "/")).alias("parent"),
        F.coalesce("name", F.lit(group)).alias("name"),
        F.col("node").alias("link"),
        F.element_at(F.concat(F.array(F.lit(0)), places), -1).alias("ordinal"),
    )
    people = extract_page_records(pages, keep=["url"], **(records or {}))
    listed = nodes.select(F.col("name").alias("department"), F.col("link").alias("url"))
    names = people.join(listed, "url").select("position", "name", "email", "department", "url")
    loads = {
        "names": stamp_snapshot(names, group, observed_at),
        "departments": stamp_snapshot(flatten_hierarchy(nodes), group, observed_at),
    }
    took = stamp_snapshot(
        spark.range(1).select(F.lit(seconds).cast("double").alias("extraction_duration_seconds")),
        group, observed_at,
    )
    return {**loads, "metadata": load_manifest(loads, durations=took)}


def update_intervals(
    raw: DataFrame,
    existing: DataFrame,
    columns: Sequence[str],
    group: str,
    key: str,
    ts: str = "_accessed_at",
    day: str | None = None,
) -> DataFrame:
    """The interval table after the latest snapshot of the raw table is merged in."""
    current = latest_snapshot(raw, columns, ts, day).withColumn(key, content_key(*columns))
    return scd2_merge(existing, current, key, columns, group)


def name_tables(intervals: DataFrame, name: str = "name", email: str = "email") -> dict:
    """Name mapping, and the histories of titles and honours, of an interval table."""
    named = split_names(intervals.withColumn(email, F.lower(email)), name)
    return {
        "names_mapping": build_name_mapping(named, ["extracted_name", name, email]),
        "prefixes_history": attribute_history(named, [email, "extracted_name", "prefix"]),
        "postfixes_history": attribute_history(named, [email, "extracted_name", "postfix"]),
    }


def stage_history(
    history: DataFrame,
    name: str,
    value: str,
    date_moves: Mapping[dt.date, dt.date],
) -> DataFrame:
    """A history of titles or honours with clean dates, one value per name and span.

    `is_latest` marks the last span of each name and value.
    """
    spans = history.select(
        name, value,
        remap_dates("effective_from", date_moves).alias("effective_from"),
        remap_dates("effective_to", date_moves).alias("effective_to"),
    )
    longest = keep_longest(spans, [name, "effective_from", "effective_to"], value)
    return flag_latest(longest, "effective_to", [name, value], few_groups=False)


def person_dim(
    mapping: DataFrame,
    name: str,
    histories: Mapping[str, DataFrame],
    private: DataFrame,
    labels: Sequence[DataFrame] = (),
    key: str = "person_key",
) -> DataFrame:
    """One row per name: its title and honours, private contact and labels.

    `histories` maps a value column to its staged history. A name may have
    several latest values; the longest is taken, so that names stay unique.
    """
    latest = [
        keep_longest(h.filter("is_latest").select(name, value), [name], value)
        for value, h in histories.items()
    ]
    return entity_dim(
        mapping, name, [private, *latest, *labels], {"has_private_value": False}, key
    )
