import datetime as dt

import pytest

from tidemark.operators.history import current_roles, flag_current, stints
from tidemark.operators.changes import Observed
from tidemark.plans.role_history import role_history


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def observed(spark, rows):
    return spark.createDataFrame(
        [(e, p, m, day(d)) for e, p, m, d in rows], "e string, p string, m string, d date"
    )


def spans(df):
    return sorted(
        ((r.e, r.p, (r.observed_from - day(0)).days, (r.observed_to - day(0)).days,
          r.observation_count) for r in df.collect()),
        key=repr,
    )


def test_gap_must_exceed_the_limit(spark):
    df = observed(spark, [("x", "a", "m", 0), ("x", "a", "m", 30), ("x", "a", "m", 61)])
    assert spans(stints(df, "e", ["p"], "d")) == [("x", "a", 0, 30, 2), ("x", "a", 61, 61, 1)]


def test_copies_of_a_date_count_and_stay_together(spark):
    df = observed(spark, [("x", "a", "m", 0), ("x", "a", "m", 40), ("x", "a", "m", 40)])
    assert spans(stints(df, "e", ["p"], "d")) == [("x", "a", 0, 0, 1), ("x", "a", 40, 40, 2)]


def test_null_attributes_are_a_key(spark):
    df = observed(spark, [("x", None, "m", 0), ("x", None, "m", 3), (None, None, "m", 3)])
    assert spans(stints(df, "e", ["p"], "d")) == [("x", None, 0, 3, 2), (None, None, 3, 3, 1)]


def test_carried_columns_share_the_stints_of_their_key(spark):
    rows = [("x", "a", m, d) for m, d in [("1", 0), ("2", 20), ("1", 45), ("2", 90), ("2", 90)]]
    rows += [("y", None, "1", 0), ("y", None, "2", 31), ("y", None, "2", 31)]
    df = observed(spark, rows)
    got = stints(df, "e", ["p"], "d", carry=["m"])
    assert sorted(
        ((r.e, r.m, r.stint_id, (r.observed_from - day(0)).days, r.observation_count)
         for r in got.collect())
    ) == [
        ("x", "1", 0, 0, 2), ("x", "2", 0, 20, 1), ("x", "2", 1, 90, 2),
        ("y", "1", 0, 0, 1), ("y", "2", 1, 31, 2),
    ]


def test_counts_add_up_to_the_observations(spark):
    df = observed(spark, [("x", "ab"[d % 2], "m", d * d) for d in range(40)])
    assert sum(r[4] for r in spans(stints(df, "e", ["p"], "d"))) == 40


def test_current_is_per_entity(spark):
    df = observed(spark, [("x", "a", "m", 0), ("x", "b", "m", 9), ("y", "a", "m", 3)])
    held = flag_current(stints(df, "e", ["p"], "d"), "e")
    assert spans(current_roles(held)) == [("x", "b", 9, 9, 1), ("y", "a", 3, 3, 1)]


def test_role_history(spark):
    rows = [
        ("Mr Jo", "jo@x", "clerk", "u1", "g", 5), ("Jo", "jo@x", "clerk", "u1", "g", 6),
        ("Jo", "jo@x", "chief", "u1", "g", 50), ("-", "z@x", "chief", "u1", "g", 50),
        ("Zed", "-", "chief", "u1", "g", 50), ("Ann", "", "chief", "u2", "g", 50),
    ]
    seen = spark.createDataFrame(
        [(*r[:5], day(r[5])) for r in rows],
        "name string, email string, position string, unit string, grp string, observed date",
    )
    mapping = spark.createDataFrame(
        [("Mr Jo", "Jo"), ("Jo", "Jo"), ("Jo", "Jo")], "raw string, clean string"
    )
    dim = spark.createDataFrame([("Jo", "key-of-jo")], "full string, id string")
    spark.sparkContext.setJobGroup("planning", "no job runs before the result is asked for")
    got = role_history(
        seen, mapping, dim, Observed(group="grp"), "raw", "clean", "full", "id",
        date_moves={day(5): day(6)},
    )
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    of_stints = [line for line in plan.split("\n") if "Exchange hashpartitioning(full_name" in line and "stint_id" in line]
    assert len([x for x in of_stints if "ReusedExchange" not in x]) == 1 and any("ReusedExchange" in x for x in of_stints)
    assert sorted(
        ((r.full_name, r.person_key, r.position, (r.observed_from - day(0)).days,
          r.observation_count, r.is_current) for r in got.collect()),
        key=repr,
    ) == [
        ("Jo", "key-of-jo", "chief", 50, 1, True), ("Jo", "key-of-jo", "clerk", 6, 2, False),
        (None, None, "chief", 50, 1, True),
    ]
