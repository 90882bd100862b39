"""Role history: who held which position where, and when."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import remap_dates
from tidemark.functions.keys import surrogate_key
from tidemark.operators.changes import Observed
from tidemark.operators.history import stints
from tidemark.operators.names import canonicalise
from tidemark.operators.scale import skew_join
from tidemark.operators.staging import drop_sentinels

# Placeholders in place of a name or a contact.
NAME_PLACEHOLDERS = ("", "-", "--")
CONTACT_PLACEHOLDERS = ("-",)


def role_history(
    observations: DataFrame,
    mapping: DataFrame,
    dim: DataFrame,
    cols: Observed,
    mapping_raw: str,
    mapping_canonical: str,
    dim_name: str,
    dim_key: str,
    gap_days: int = 30,
    date_moves: Mapping[dt.date, dt.date] | None = None,
    placeholders: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """One row per canonical name, position, unit and stint.

    A name without a mapping has a null canonical name. Current means the last
    stint of that name, not presence in the last snapshot. The assignment key
    leaves out contact and group, which the rows are also split by.
    """
    if placeholders is None:
        placeholders = {cols.name: NAME_PLACEHOLDERS, cols.entity: CONTACT_PLACEHOLDERS}
    rows = drop_sentinels(observations, placeholders).withColumn(
        cols.date, remap_dates(cols.date, date_moves or {})
    )

    rows = canonicalise(
        rows, mapping, cols.name, mapping_raw, mapping_canonical, "full_name", fallback=False
    )
    keys = [cols.position, cols.unit]
    held = stints(
        rows, "full_name", keys, cols.date, gap_days, carry=[cols.entity, cols.group]
    )
    # Key and last date join per name first, so that the rows are joined only once. The
    # last date is the largest of whole rows, which asks for the same columns as the rows
    # do: so both sides end in the same exchange, and Spark runs it once.
    people = dim.select(F.col(dim_name).alias("_dim_name"), F.col(dim_key).alias("person_key"))
    latest = F.max(F.struct("observed_to", *[c for c in held.columns if c not in ("full_name", "observed_to")]))
    names = (
        held.groupBy(F.col("full_name").alias("_name"))
        .agg(latest["observed_to"].alias("_last"))
        .join(people, F.col("_name") == F.col("_dim_name"), "left")
    )
    return skew_join(held, names, [("full_name", "_name")], "left").select(
        surrogate_key("full_name", cols.position, cols.unit, "stint_id").alias(
            "role_assignment_key"
        ),
        "person_key", "full_name", cols.entity, cols.position, cols.unit, cols.group,
        "observed_from", "observed_to", "observation_count",
        (F.col("observed_to") == F.col("_last")).alias("is_current"),
    )
