import pytest
from pyspark.sql import functions as F

from tidemark.operators import summary
from tidemark.plans.report import report_tables


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("1", "M"), ("2", "F"), ("3", None), ("4", "Unknown"), ("5", "F")], "k string, sex string"
    )


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [("1", "Old"), ("1", "New"), ("2", "New"), ("3", "Court"), ("5", "Court"), ("4", None)],
        "k string, grp string",
    )


def test_share_of_total(spark, people, rows):
    assert rows(summary.share_of_total(people, "sex")) == sorted(
        [("F", 2, 40.0), ("M", 1, 20.0), (None, 1, 20.0), ("Unknown", 1, 20.0)], key=repr
    )


def test_null_and_literal_unknown_stay_apart(people, rows):
    got = summary.category_counts(people, "sex")
    assert got.first()[0] == "F"
    assert rows(got) == [("F", 2), ("M", 1), ("Unknown", 1), ("Unknown", 1)]


def test_breakdown_and_headcount(facts, people, rows):
    assert rows(summary.breakdown(facts, people, "k", "grp", "sex")) == [
        ("Court", "F", 1), ("Court", "Unknown", 1), ("New", "F", 1), ("New", "M", 1),
        ("Old", "M", 1),
    ]
    assert rows(summary.headcount(facts, "k", "grp")) == [("Court", 2), ("New", 2), ("Old", 1)]


def test_renamed_groups(facts, rows):
    heads = summary.headcount(facts, "k", "grp")
    added = summary.rollup_renamed(heads, "grp", {"Old": "New"}, count="headcount")
    assert rows(added) == [("Court", 2), ("New", 3)]
    distinct = summary.rollup_renamed(
        facts.filter("grp is not null"), "grp", {"Old": "New"}, entity="k"
    )
    assert rows(distinct) == [("Court", 2), ("New", 2)]
    assert rows(summary.rollup_renamed(heads, "grp", {}, count="headcount")) == rows(heads)


def test_completeness(spark, people):
    rules = {"has": F.col("sex").isNotNull() & (F.col("sex") != "Unknown"), "one": F.col("k") == "1"}
    got = {r.metric: (r.total, r["count"], r.pct) for r in summary.completeness(people, rules).collect()}
    assert got == {"has": (5, 3, 60.0), "one": (5, 1, 20.0)}
    none = summary.completeness(people.limit(0), rules).collect()
    assert [(r.total, r["count"], r.pct) for r in none] == [(0, 0, 0.0)] * 2
    eighth = summary.completeness(spark.range(800), {"x": F.col("id") < 98}).first()
    assert eighth.pct == 12.2


def test_pivot_and_row_percent(spark, rows):
    counts = spark.createDataFrame(
        [("b", "y", 1), ("a", "x", 3), ("a", "y", 1), ("z", "x", 0)], "g string, c string, count long"
    )
    wide = summary.pivot_counts(counts, "g", "c", ["x", "y"])
    assert wide.columns == ["g", "x", "y"]
    assert [tuple(r) for r in wide.collect()] == [("a", 3, 1), ("b", 0, 1), ("z", 0, 0)]
    assert rows(summary.pivot_counts(counts, "g", "c", categories=["y"])) == [
        ("a", 1), ("b", 1), ("z", 0),
    ]
    assert rows(summary.row_percent(wide, "g")) == [
        ("a", 75.0, 25.0), ("b", 0.0, 100.0), ("z", 0.0, 0.0),
    ]


def test_pivot_with_a_null_category_and_the_long_form(spark, rows):
    counts = spark.createDataFrame(
        [("a", "x", 3), ("b", None, 2), ("a", None, 1)], "g string, c string, count long"
    )
    wide = summary.pivot_counts(counts, "g", "c", ["x", None])
    assert wide.columns == ["g", "x", "null"] and rows(wide) == [("a", 3, 1), ("b", 0, 2)]
    assert rows(summary.cell_counts(counts, "g", "c")) == [("a", "x", 3), ("a", None, 1), ("b", None, 2)]


def test_split_by_membership(facts):
    outside, inside = summary.split_by_membership(facts, "grp", ["Court"])
    assert (outside.count(), inside.count()) == (4, 2)


def test_sample_unlabelled(spark):
    df = spark.createDataFrame(
        [("Zoe Z", "Unknown"), ("Amy", "Unknown"), ("(Vacant)", "Unknown"), ("Anna", "Unknown"),
         ("Known", "A"), (None, "Unknown")],
        "n string, l string",
    )
    got = summary.sample_unlabelled(df, "n", "l", placeholders=["(Vacant)"], n=2)
    assert [r[0] for r in got.collect()] == ["Anna", "Zoe Z"]


def test_report(facts, people, rows):
    got = report_tables(
        facts, people, "k", "grp", {"sex": ["F", "M", "Unknown"]}, {"sex": F.col("sex").isNotNull()}, {"Old": "New"},
        ["Court"],
    )
    assert rows(got["completeness"], "pct", "band") == [(80.0, "high")]
    assert rows(got["headcount"]) == [("New", 3)] and rows(got["headcount_apart"]) == [("Court", 2)]
    assert rows(got["sex_by_group"]) == [("New", 1, 2, 0)]
    assert rows(got["sex_by_group_apart"]) == [("Court", 1, 0, 1)]
