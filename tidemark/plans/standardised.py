"""Facts over standardised observations: the change feed and private contacts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import remap_dates
from tidemark.operators.attributes import latest_private_value
from tidemark.operators.changes import GENERIC_CONTACTS, Observed, change_feed
from tidemark.operators.names import canonicalise
from tidemark.operators.scale import skew_join
from tidemark.operators.staging import drop_sentinels
from tidemark.plans.role_history import CONTACT_PLACEHOLDERS, NAME_PLACEHOLDERS

# What stands in place of a contact where private ones are sought.
NO_CONTACT = ("-", ".", "na", "")


def change_facts(
    observations: DataFrame,
    mapping: DataFrame,
    cols: Observed,
    mapping_raw: str,
    mapping_canonical: str,
    baseline: dt.date,
    date_moves: Mapping[dt.date, dt.date] | None = None,
    placeholders: Mapping[str, Iterable[str]] | None = None,
    patterns: Sequence[str] = GENERIC_CONTACTS,
) -> DataFrame:
    """The change feed over observations without placeholders, with moved dates and canonical names.

    A name without a mapping, or with an empty one, stays as it is.
    """
    if placeholders is None:
        placeholders = {cols.name: NAME_PLACEHOLDERS, cols.entity: CONTACT_PLACEHOLDERS}
    rows = drop_sentinels(observations, placeholders).withColumn(
        cols.date, remap_dates(cols.date, date_moves or {})
    )
    named = canonicalise(rows, mapping, cols.name, mapping_raw, mapping_canonical, "_canonical")
    named = named.drop(cols.name).withColumnRenamed("_canonical", cols.name)
    return change_feed(named, cols, baseline, patterns)


def private_contacts(
    observations: DataFrame,
    mapping: DataFrame,
    name: str,
    contact: str,
    observed: str,
    mapping_raw: str,
    mapping_canonical: str,
    placeholders: Iterable[str] = NO_CONTACT,
) -> DataFrame:
    """Per canonical name its latest contact that no other canonical name ever used.

    Names are found through the mapping only; contacts are compared in lower case.
    """
    pairs = mapping.select(F.col(mapping_raw).alias("_raw"), F.col(mapping_canonical).alias("canonical_name"))
    pairs = pairs.filter("canonical_name is not null and _raw is not null").distinct()
    rows = observations.filter(F.col(contact).isNotNull() & ~F.col(contact).isin(*placeholders))
    named = skew_join(rows.select(name, contact, observed), pairs, [(name, "_raw")], "inner")
    return latest_private_value(
        named.select("canonical_name", F.lower(contact).alias(contact), observed), "canonical_name", contact, observed
    )
