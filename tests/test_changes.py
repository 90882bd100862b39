import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as c

COLS = c.Observed("email", "name", "position", "unit", "grp", "observed")
SCHEMA = "email string, name string, position string, unit string, grp string, observed date"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def seen(spark, rows):
    return spark.createDataFrame([(*r[:5], day(r[5])) for r in rows], SCHEMA)


def feed(spark, rows, baseline=0, **options):
    got = c.change_feed(seen(spark, rows), COLS, day(baseline), **options)
    return sorted(
        ((r.activity, r.entity, (r.activity_date - day(0)).days, r.old_information)
         for r in got.collect()),
        key=repr,
    )


def test_every_activity(spark):
    rows = [
        ("a@x", "Ann Lee", "clerk", "u1", "g", 0), ("a@x", "Lee Ann", "clerk", "u1", "g", 1),
        ("b@x", "Bob", "clerk", "u1", "g", 0), ("b@x", "Zoe", "clerk", "u1", "g", 1),
        ("c@x", "Cy", "clerk", "u1", "g", 0), ("c@x", "Cy", "clerk", "u1", "h", 1),
        ("d@x", "Di", "clerk", "u1", "g", 0), ("d@x", "Di", "chief", "u2", "g", 1),
        ("e@x", "Ed", "clerk", "u1", "g", 0), ("e@x", "Ed", "clerk", "u2", "g", 1),
        ("f@x", "Flo", "clerk", "u1", "g", 0), ("f@x", "Flo", "chief", "u1", "g", 1),
        ("g@x", "Gus", "clerk", "u1", "g", 0),
        ("h@x", "Hal", "clerk", "u1", "g", 1),
    ]
    assert feed(spark, rows) == [
        ("change department (different role)", "d@x", 1, "(clerk, u1)"),
        ("change department (same role)", "e@x", 1, "u1"),
        ("change ministry", "c@x", 1, "(g, clerk, u1)"),
        ("change role (same department)", "f@x", 1, "clerk"),
        ("email reassignment", "b@x", 1, "Bob"),
        ("name change", "a@x", 1, "Ann Lee"),
        ("new joiner", "h@x", 1, None),
        ("resigned", "g@x", 0, None),
    ]


def test_one_row_may_yield_several(spark):
    rows = [("a@x", "Ann Lee", "clerk", "u", "g", 0), ("a@x", "Ann Low", "chief", "u", "h", 1)]
    assert [r[0] for r in feed(spark, rows)] == ["change ministry", "name change"]


def test_null_is_no_difference(spark):
    rows = [("a@x", "Ann", None, "u", "g", 0), ("a@x", "Ann", "clerk", "u", "g", 1),
            ("a@x", "Ann", "clerk", "u", "g", 2)]
    df = seen(spark, rows)
    assert c.changed_rows(c.with_previous(df, COLS), COLS, day(0)).isEmpty()


def test_case_of_the_entity_does_not_count(spark):
    rows = [("A@x", "Ann", "p", "u", "g", 0), ("a@X", "Ann", "p", "u", "g", 1)]
    assert feed(spark, rows) == []


def test_present_on_the_last_date_is_not_gone(spark):
    rows = [("a@x", "Ann", "p", "u", "g", 0), ("b@x", "Bo", "p", "u", "g", 3)]
    assert feed(spark, rows, baseline=3) == [("resigned", "a@x", 0, None)]


def test_several_positions_on_a_date_exclude_the_entity(spark):
    rows = [("a@x", "Ann", "p", "u", "g", 0), ("a@x", "Ann", "q", "u", "g", 0),
            ("a@x", "Ann", "q", "u", "g", 1), ("b@x", "Bo", "p", "u", "g", 1),
            ("c@x", "Cy", None, "u", "g", 1), ("ceo@x", "Di", "p", "u", "g", 1)]
    df = seen(spark, rows)
    assert [r[0] for r in c.single_position_entities(df, COLS).orderBy("email").collect()] == [
        "b@x", "ceo@x",
    ]
    only = c.single_position_entities(df, COLS, c.GENERIC_CONTACTS)
    assert [r[0] for r in only.collect()] == ["b@x"]
    assert c.only_entities(df, only, COLS).count() == 1
    assert {r[1] for r in feed(spark, rows)} == {"b@x"}


def test_generic_values(spark):
    df = spark.createDataFrame([("Director@x",), ("director@X",), ("me@x",)], "email string")
    assert [r[0] for r in c.generic_values(df, "email").collect()] == ["director@x"]


def many(seed, entities=4, days=12, per_day=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(entities * days * per_day):
        e = rng.choice(["hot@x"] * 3 + [f"e{i}@x" for i in range(entities)])
        rows.append(
            (e.upper() if rng.random() < 0.2 else e, rng.choice(["Ann Lee", "Lee", "Bo", "Anne"]),
             f"p{rng.randrange(2)}", "u", None if rng.random() < 0.1 else f"g{rng.randrange(2)}",
             rng.randrange(days))
        )
    return rows


def test_neighbours_by_hand(spark, rows):
    """Across names of a date, dates, nulls and copies, in the order of a plain sort."""
    data = many(3) + many(3)[:30]
    expected = {}
    for e, n, p, u, g, d in sorted(set(data), key=lambda r: (r[0].lower(), r[5], r[1], r[2], r[3], r[4] or "", r[0])):
        expected.setdefault(e.lower(), []).append((day(d), n, p, u, g))
    pairs = []
    for run in expected.values():
        pairs += [(a, b) for a, b in zip([None, *run], run, strict=False)]
    got = c.with_previous(seen(spark, data).repartition(5), COLS)
    attributes = [COLS.date, *COLS.attributes]
    found = rows(got, *attributes, *[f"lag_{a}" for a in attributes])
    assert found == sorted((b + (a or (None,) * 5) for a, b in pairs), key=repr)


def test_names_of_one_date_are_spread_over_tasks(spark):
    """One entity, one date, names with a common start: rows are dealt out by name."""
    data = [("a@x", f"Same start {i}", "p", "u", "g", 1) for i in range(2000)]
    found = c.with_previous(seen(spark, data), COLS)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_entity" in text
    spread = seen(spark, data).repartition(8, "email", "observed", "name").select(F.spark_partition_id().alias("p"))
    assert spread.distinct().count() > 4
    assert found.filter("lag_name is null").count() == 1 and found.count() == 2000


def test_feed_equals_the_single_operators(spark, rows):
    df = seen(spark, many(7))
    single = c.only_entities(df, c.single_position_entities(df, COLS), COLS)
    changed = c.changed_rows(c.with_previous(single, COLS), COLS, day(1))
    parts = [
        c.new_entities(changed, COLS), c.renames(changed, COLS), c.reassignments(changed, COLS),
        c.group_changes(changed, COLS), c.unit_changes(changed, COLS, True),
        c.unit_changes(changed, COLS, False), c.role_changes(changed, COLS),
        c.disappearances(c.with_next(single, COLS), COLS, df),
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    assert rows(c.change_feed(df, COLS, day(1), patterns=())) == rows(together)


def test_copies_and_order_of_rows_do_not_matter(spark):
    data = many(11)
    shuffled = data + data[:20]
    random.Random(1).shuffle(shuffled)
    assert feed(spark, data) == feed(spark, shuffled)
