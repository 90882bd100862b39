"""The change feed: what became of each entity between two snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import matches_any, shares_word
from tidemark.operators.scale import neighbours, skew_join

# LIKE patterns of contacts that belong to a post and not to a person.
GENERIC_CONTACTS = (
    "http%",
    "%enquir%", "%feedback%",
    "%head@%", "director@%", "%dean@%", "%provost%",
    "contact@%", "%_qsm@%", "%qsm@%",
    "chairman@%", "ceo@%", "president@%", "vpr@%", "execdir%", "ad-%", "d-%", "csoci@%",
    "workright%",
)

# Names of the activities.
JOINED = "new joiner"
RENAMED = "name change"
REASSIGNED = "email reassignment"
CHANGED_GROUP = "change ministry"
CHANGED_UNIT_AND_ROLE = "change department (different role)"
CHANGED_UNIT = "change department (same role)"
CHANGED_ROLE = "change role (same department)"
GONE = "resigned"


@dataclass(frozen=True)
class Observed:
    """Column names of an observation: who, called what, doing what, where, when."""

    entity: str = "email"
    name: str = "name"
    position: str = "position"
    unit: str = "unit"
    group: str = "group"
    date: str = "observed"

    @property
    def attributes(self) -> list[str]:
        return [self.name, self.position, self.unit, self.group]

    @property
    def order(self) -> list[str]:
        """Date first; equal dates by the attributes, so that equal rows adjoin."""
        return [self.date, *self.attributes, self.entity]


def generic_values(
    df: DataFrame, col: str, patterns: Sequence[str] = GENERIC_CONTACTS
) -> DataFrame:
    """Distinct lower-cased values that are LIKE one of the patterns."""
    return df.filter(matches_any(col, patterns)).select(F.lower(col).alias(col)).distinct()


def single_position_entities(
    df: DataFrame, cols: Observed, patterns: Sequence[str] = ()
) -> DataFrame:
    """Entities that never hold more than one position on a date, generic ones left out.

    One position on a date means that the smallest and largest agree, which
    needs no distinct count. A position with a null part is not counted.
    """
    return _single_position(df.filter(~matches_any(cols.entity, patterns)), cols)


def _place(cols: Observed) -> Column:
    return F.concat(cols.position, cols.unit, cols.group)


def _single_position(df: DataFrame, cols: Observed) -> DataFrame:
    return (
        df.groupBy(F.lower(cols.entity).alias(cols.entity), cols.date)
        .agg(F.min(_place(cols)).alias("_low"), F.max(_place(cols)).alias("_high"))
        .groupBy(cols.entity)
        .agg(
            F.bool_and(F.col("_low").eqNullSafe(F.col("_high"))).alias("_single"),
            F.bool_or(F.col("_low").isNotNull()).alias("_any"),
        )
        .filter("_single and _any")
        .select(cols.entity)
    )


def only_entities(df: DataFrame, entities: DataFrame, cols: Observed) -> DataFrame:
    """The observations of the listed (lower-cased) entities."""
    wanted = entities.select(F.col(cols.entity).alias("_wanted"))
    rows = df.withColumn("_entity", F.lower(cols.entity))
    return skew_join(rows, wanted, [("_entity", "_wanted")], "left_semi").drop("_entity")


def _neighbours(df: DataFrame, cols: Observed, single: bool = False) -> DataFrame:
    """Distinct observations with both neighbours, and whether the entity is single.

    An entity holds one position throughout if the smallest and largest agree on
    every date, which the windows over its dates tell along the way.
    """
    keyed = df.withColumn("_entity", F.lower(cols.entity)).filter(F.col("_entity").isNotNull())
    rows = keyed.select("_entity", cols.entity, *cols.attributes, cols.date)
    same = F.col("_low").eqNullSafe(F.col("_high"))
    some = F.col("_low").isNotNull()
    found = neighbours(
        rows, "_entity", cols.date, cols.name,
        [cols.position, cols.unit, cols.group, cols.entity], [cols.date, *cols.attributes],
        lowest_highest=_place(cols) if single else None,
        per_key={"_same": F.bool_and(same), "_some": F.bool_or(some)} if single else None,
    )
    return found.drop("_entity")


def _shifted(cols: Observed, side: str, prefix: str) -> list[Column]:
    return [F.col(f"{side}.{c}").alias(f"{prefix}{c}") for c in (cols.date, *cols.attributes)]


def with_previous(df: DataFrame, cols: Observed) -> DataFrame:
    """Distinct observations with `lag_<column>` of the entity's previous one."""
    both = _neighbours(df, cols)
    return both.select("*", *_shifted(cols, "previous", "lag_")).drop("previous", "following")


def with_next(df: DataFrame, cols: Observed) -> DataFrame:
    """Distinct observations with `lead_<column>` of the entity's next one."""
    both = _neighbours(df, cols)
    return both.select("*", *_shifted(cols, "following", "lead_")).drop("previous", "following")


def _lag(col: str) -> Column:
    return F.col(f"lag_{col}")


def _is_changed(cols: Observed, baseline: dt.date) -> Column:
    differs = _lag(cols.name).isNull()
    for attribute in cols.attributes:
        differs = differs | (F.col(attribute) != _lag(attribute))
    return (F.col(cols.date) > F.lit(baseline)) & differs


def changed_rows(previous: DataFrame, cols: Observed, baseline: dt.date) -> DataFrame:
    """After the baseline: rows without a predecessor, or unlike it in an attribute.

    A null on either side is no difference.
    """
    return previous.filter(_is_changed(cols, baseline))


def _output(cols: Observed, activity: Column | str, old: Column, against: Column) -> list[Column]:
    """The nine output columns of an activity."""
    return [
        (F.lit(activity) if isinstance(activity, str) else activity).alias("activity"),
        F.col(cols.date).alias("activity_date"),
        F.col(cols.name).alias("name"),
        F.col(cols.entity).alias("entity"),
        F.col(cols.position).alias("position"),
        F.col(cols.unit).alias("unit"),
        F.col(cols.group).alias("group_name"),
        old.cast("string").alias("old_information"),
        against.alias("compared_against_date"),
    ]


def _activities(cols: Observed, alike: Column) -> dict[str, tuple[Column, Column]]:
    """Condition and old information of the activities found by looking back.

    `alike` tells whether the names share a word.
    """
    name, position, unit, group = cols.attributes
    none = F.lit(None)
    same_group = F.col(group) == _lag(group)
    same_unit, other_unit = F.col(unit) == _lag(unit), F.col(unit) != _lag(unit)
    other_role = F.col(position) != _lag(position)
    renamed = F.col(name) != _lag(name)

    def listed(*parts: str) -> Column:
        between = [x for part in parts for x in (F.lit(", "), _lag(part))]
        return F.concat(F.lit("("), *between[1:], F.lit(")"))

    no_predecessor = F.lit(True)
    for attribute in cols.attributes:
        no_predecessor = no_predecessor & _lag(attribute).isNull()
    return {
        JOINED: (no_predecessor, none),
        RENAMED: (renamed & alike, _lag(name)),
        REASSIGNED: (renamed & ~alike, _lag(name)),
        CHANGED_GROUP: (F.col(group) != _lag(group), listed(group, position, unit)),
        CHANGED_UNIT_AND_ROLE: (same_group & other_unit & other_role, listed(position, unit)),
        CHANGED_UNIT: (
            same_group & other_unit & (F.col(position) == _lag(position)), _lag(unit),
        ),
        CHANGED_ROLE: (same_group & same_unit & other_role, _lag(position)),
    }


def activity(changed: DataFrame, cols: Observed, which: str) -> DataFrame:
    """The rows of one activity out of the changed rows."""
    condition, old = _activities(cols, shares_word(_lag(cols.name), cols.name))[which]
    return changed.filter(condition).select(*_output(cols, which, old, _lag(cols.date)))


def new_entities(changed: DataFrame, cols: Observed) -> DataFrame:
    """Entities without any earlier observation."""
    return activity(changed, cols, JOINED)


def renames(changed: DataFrame, cols: Observed) -> DataFrame:
    """The name changed but shares a word with the old one."""
    return activity(changed, cols, RENAMED)


def reassignments(changed: DataFrame, cols: Observed) -> DataFrame:
    """The name changed and shares no word with the old one."""
    return activity(changed, cols, REASSIGNED)


def group_changes(changed: DataFrame, cols: Observed) -> DataFrame:
    """The top-level group changed."""
    return activity(changed, cols, CHANGED_GROUP)


def unit_changes(changed: DataFrame, cols: Observed, same_role: bool) -> DataFrame:
    """The unit changed inside the group, with the same or another position."""
    return activity(changed, cols, CHANGED_UNIT if same_role else CHANGED_UNIT_AND_ROLE)


def role_changes(changed: DataFrame, cols: Observed) -> DataFrame:
    """Only the position changed."""
    return activity(changed, cols, CHANGED_ROLE)


def _is_gone(cols: Observed, latest: Column, prefix: str) -> Column:
    gone = F.col(cols.date) < latest
    for attribute in (cols.position, cols.unit, cols.group):
        gone = gone & F.col(f"{prefix}{attribute}").isNull()
    return gone


def disappearances(following: DataFrame, cols: Observed, observations: DataFrame) -> DataFrame:
    """Last rows of entities that end before the last date of all observations."""
    latest = observations.agg(F.max(cols.date).alias("latest")).scalar()
    return following.filter(_is_gone(cols, latest, "lead_")).select(
        *_output(cols, GONE, F.lit(None), F.col(f"lead_{cols.date}"))
    )


def change_feed(
    df: DataFrame,
    cols: Observed,
    baseline: dt.date,
    patterns: Sequence[str] = GENERIC_CONTACTS,
) -> DataFrame:
    """All activities of single-position entities; a row may yield several.

    Rows are shuffled once. Which entities count, and both neighbours of a row,
    come from windows over first and last rows (see `neighbours`); each row then
    puts out whatever activities hold, instead of one scan per activity and a union.
    """
    latest = df.agg(F.max(cols.date).alias("latest")).scalar()
    personal = df.filter(~matches_any(cols.entity, patterns))
    rows = _neighbours(personal, cols, single=True).filter("_same and _some").select(
        "*",
        *_shifted(cols, "previous", "lag_"),
        *_shifted(cols, "following", "lead_"),
        latest.alias("_latest"),
    )
    looking_back = _activities(cols, F.col("_alike"))
    # Names of the activities first, so that what goes with them is worked out
    # only for rows that are put out, and inside generated code.
    found = [
        F.when(F.col("_changed") & condition, which)
        for which, (condition, _) in looking_back.items()
    ]
    found.append(F.when(_is_gone(cols, F.col("_latest"), "lead_"), GONE))
    which = F.col("_activity")
    old = F.coalesce(*[F.when(which == name, o) for name, (_, o) in looking_back.items()])
    against = F.when(which == GONE, F.col(f"lead_{cols.date}")).otherwise(_lag(cols.date))
    return (
        rows.withColumns(
            {
                "_changed": _is_changed(cols, baseline),
                "_alike": F.when(
                    F.col(cols.name) != _lag(cols.name), shares_word(_lag(cols.name), cols.name)
                ),
            }
        )
        .select("*", F.explode(F.array(*found)).alias("_activity"))
        .filter(which.isNotNull())
        .select(*_output(cols, which, old, against))
    )
