import datetime as dt
import random

import pytest

from tidemark.operators.scd2 import last_seen, scd2_merge
from tidemark.operators.snapshots import latest_snapshot
from tidemark.plans.directory import update_intervals

SCHEMA = "k string, a string, g string, _valid_from timestamp_ntz, _valid_to timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, a, g, day(f), day(t)) for k, a, g, f, t in rows], SCHEMA)


def merged(spark, existing, current, **options):
    old, new = frame(spark, existing), frame(spark, current)
    out = scd2_merge(old, new, "k", ["a", "g"], "g", **options)
    return sorted(
        ((r.k, r.a, r.g, (r._valid_from - day(0)).days, (r._valid_to - day(0)).days)
         for r in out.collect()),
        key=repr,
    )


def by_hand(existing, current):
    """The rule read out per key on plain lists."""
    seen, groups, out = {}, {}, []
    for k, a, g, f, t in existing:
        seen[g] = max(seen.get(g, t), t)
    for source, rows in enumerate((existing, current)):
        for k, a, g, f, t in rows:
            groups.setdefault(k, []).append((f, source, t, a, g))
    for k, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        if len(rows) > 1 and rows[-2][2] == seen.get(rows[-2][4]):
            one, two = rows[-2:]
            rows[-2:] = [(min(one[0], two[0]), 0, max(one[2], two[2]), one[3], one[4])]
        out += [(k, a, g, f, t) for f, _, t, a, g in rows]
    return sorted(out, key=repr)


CASES = {
    "one row stays": ([("x", "1", "g", 0, 5)], []),
    "seen again": ([("x", "1", "g", 0, 5)], [("x", "1", "g", 7, 7)]),
    "came back": (
        [("x", "1", "g", 0, 2), ("y", "2", "g", 0, 5)], [("x", "1", "g", 7, 7)],
    ),
    "three rows": (
        [("x", "1", "g", 0, 1), ("x", "1", "g", 3, 5)], [("x", "1", "g", 7, 7)],
    ),
    "vanished": ([("x", "1", "g", 0, 5), ("y", "2", "g", 0, 5)], [("y", "2", "g", 7, 7)]),
    "null attribute": ([("x", None, "g", 0, 5)], [("x", None, "g", 7, 7)]),
    "null group": ([("x", "1", None, 0, 5)], [("x", "1", None, 7, 7)]),
    "new group": ([("x", "1", "g", 0, 5)], [("z", "1", "h", 7, 7), ("z", "1", "h", 8, 8)]),
    "new key": ([("x", "1", "g", 0, 5)], [("z", "9", "g", 7, 7)]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("pass_closed", [True, False])
def test_cases(spark, case, pass_closed):
    existing, current = CASES[case]
    got = merged(spark, existing, current, pass_closed=pass_closed)
    assert got == by_hand(existing, current)


def test_overlapping_intervals_need_all_rows(spark):
    existing = [("x", "1", "g", 0, 10), ("x", "1", "g", 5, 7)]
    assert merged(spark, existing, [], pass_closed=False) == by_hand(existing, [])


def test_two_loads_on_one_date_run_twice(spark):
    existing = [("x", "1", "g", 0, 7)]
    current = [("x", "1", "g", 7, 7), ("x", "1", "g", 8, 8)]
    assert merged(spark, existing, current) == by_hand(existing, current)


def test_null_attribute_is_extended(spark):
    assert merged(spark, *CASES["null attribute"]) == [("x", None, "g", 0, 7)]


def test_random_histories_and_rerun(spark):
    rng = random.Random(5)
    state = [("k0", "a0", "g0", 0, 0)]
    for load in range(1, 7):
        keys = [k for k in range(12) if rng.random() < 0.6]
        current = [(f"k{k}", f"a{k}", f"g{k % 3}", load * 3, load * 3) for k in keys]
        state, before = merged(spark, state, current), state
        assert state == by_hand(before, current)
    assert merged(spark, state, current) == state


def test_intervals_of_a_key_do_not_overlap(spark):
    state = []
    for load, keys in enumerate(["ab", "b", "abc", "c", "abc"]):
        current = [(k, k, "g", load, load) for k in keys]
        state = merged(spark, state, current) if state else current
    spans = {}
    for k, _, _, f, t in state:
        spans.setdefault(k, []).append((f, t))
    assert spans["a"] == [(0, 0), (2, 2), (4, 4)] and spans["b"] == [(0, 2), (4, 4)]


def test_order_of_rows_does_not_matter(spark):
    existing, current = CASES["three rows"]
    assert merged(spark, existing[::-1], current) == merged(spark, existing, current)


def test_last_seen(spark, rows):
    df = frame(spark, [("x", "1", "g", 0, 5), ("y", "1", "g", 0, 7), ("z", "1", "h", 0, 1)])
    assert rows(last_seen(df, "g")) == [("g", day(7)), ("h", day(1))]


def test_latest_snapshot_is_one_date_over_all_groups(spark, rows):
    raw = spark.createDataFrame(
        [("x", "g", day(3)), ("x", "g", day(3)), ("y", "h", day(4)),
         ("z", "h", day(4) + dt.timedelta(hours=5))],
        "n string, g string, _accessed_at timestamp_ntz",
    )
    got = rows(latest_snapshot(raw, ["n", "g"]))
    later = day(4) + dt.timedelta(hours=5)
    assert got == [("y", "h", day(4), day(4)), ("z", "h", later, later)]


def test_update_intervals(spark, rows):
    raw = spark.createDataFrame(
        [("x", "g", day(0)), ("x", "g", day(7)), ("y", "g", day(7))],
        "n string, g string, _accessed_at timestamp_ntz",
    )
    first = latest_snapshot(raw.filter("_accessed_at < date'2024-01-05'"), ["n", "g"])
    from tidemark.functions.keys import content_key

    existing = first.withColumn("id", content_key("n", "g"))
    got = update_intervals(raw, existing, ["n", "g"], "g", "id")
    assert rows(got, "n", "_valid_from", "_valid_to") == [
        ("x", day(0), day(7)), ("y", day(7), day(7)),
    ]
