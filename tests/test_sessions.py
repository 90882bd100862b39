import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sessions
from tidemark.operators.sessions import assign_session, gap_sessions, load_history
from tidemark.session import stored

START = dt.datetime(2024, 3, 1, 9)


def times(spark, seconds, group="g"):
    rows = [(group, START + dt.timedelta(seconds=s)) for s in seconds]
    return spark.createDataFrame(rows, "g string, ts timestamp_ntz")


def spans(df):
    return [
        (r.session_id, (r.session_start - START).total_seconds(),
         (r.session_end - START).total_seconds(), r.session_duration_hours)
        for r in df.orderBy("session_id").collect()
    ]


@pytest.mark.parametrize(
    "seconds, expected",
    [
        ([0], [(1, 0, 0, 0.0)]),
        ([0, 100], [(1, 0, 100, 0.02778)]),
        ([0, 60_911], [(1, 0, 60_911, 16.91972)]),
        ([0, 60_912], [(1, 0, 0, 0.0), (2, 60_912, 60_912, 0.0)]),
        ([0, 3600, 103_600], [(1, 0, 3600, 1.0), (2, 103_600, 103_600, 0.0)]),
    ],
)
def test_gaps(spark, seconds, expected):
    assert spans(gap_sessions(times(spark, seconds), "ts")) == expected


def by_hand(seconds, threshold, digits):
    out = []
    for s in sorted(seconds):
        if out and round(int(s - out[-1][1]) / 86_400 + 1e-12, digits) <= threshold:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("threshold, digits", [(0.7, 2), (0.01, 2), (0.0139, 5), (0.706, 2)])
def test_random_times(spark, threshold, digits):
    rng = random.Random(threshold)
    seconds, at = [], 0.0
    for _ in range(150):
        at += rng.choice([1, 0.3, 1.02, 2]) * rng.uniform(0.2, 1.1) * threshold * 86_400
        seconds.append(round(at, 3))
    got = spans(gap_sessions(times(spark, seconds), "ts", threshold, round_days=digits))
    assert [(s, e) for _, s, e, _ in got] == by_hand(seconds, threshold, digits)
    assert [r[0] for r in got] == list(range(1, len(got) + 1))


def test_partitions_have_their_own_sessions(spark):
    df = times(spark, [0, 100_000]).unionByName(times(spark, [5], "h"))
    got = gap_sessions(df, "ts", partition=["g"]).orderBy("g", "session_id").collect()
    assert [(r.g, r.session_id) for r in got] == [("g", 1), ("g", 2), ("h", 1)]


def test_times_before_1970(spark):
    df = times(spark, [-2_000_000_000, -1_999_999_990])
    assert len(spans(gap_sessions(df, "ts"))) == 1


def test_assign_keeps_rows_outside_all_sessions(spark):
    df = times(spark, [0, 50, 100_000, 250_000])
    found = gap_sessions(df, "ts").filter("session_id != 2")
    got = assign_session(df, found, "ts").orderBy("ts").collect()
    assert [r.session_id for r in got] == [1, 1, None, 3]


def test_a_session_over_several_days(spark):
    df = times(spark, range(0, 400_000, 20_000))
    found = gap_sessions(df, "ts")
    assert assign_session(df, found, "ts").filter("session_id = 1").count() == 20


def test_load_history(spark):
    manifest = spark.createDataFrame(
        [("names", "g", 5, START), ("names", None, 7, START + dt.timedelta(days=7))],
        "table_name string, group_name string, num_rows int, _accessed_at timestamp_ntz",
    )
    got = load_history(manifest, gap_sessions(manifest, "_accessed_at")).collect()
    assert [r.session_id for r in got] == [1, 2]
    assert len({r.metadata_id for r in got}) == 2


def test_a_busy_day_is_cut_into_pieces(spark, monkeypatch):
    """Sessions go on over pieces; one day without a partition column is many tasks' work."""
    kept = []
    monkeypatch.setattr(sessions, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(4)
        at = sorted(rng.sample(range(80_000), 3000))
        df = spark.createDataFrame([(s,) for s in at], "s long").select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
        found = [(i, s, s + rng.randint(0, 900)) for i, s in enumerate(range(0, 80_000, 1000)) if rng.random() < 0.8]
        whole = (99, 80_500, 90_000)
        told = spark.createDataFrame([*found, whole], "session_id long, a long, b long").select(
            "session_id", *[F.timestamp_seconds(c).cast("timestamp_ntz").alias(n) for c, n in (("a", "session_start"), ("b", "session_end"))]
        )
        got = {r.ts: r.session_id for r in sessions.assign_session(df, told, "ts").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for s in at:
        inside = [i for i, a, b in found if a <= s <= b]
        assert got[dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)] == (inside[0] if inside else None)
    sizes = [r["count"] for r in kept[0].groupBy("_piece").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_pieces_of_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 5000)) for _ in range(400)] + [("a", None)]
    found = [(p, i, s, s + 120) for p in ("a", None) for i, s in enumerate(range(0, 5000, 300))]
    df = spark.createDataFrame(rows, "p string, s long").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    told = spark.createDataFrame(found, "p string, session_id long, a long, b long").select(
        "p", "session_id", *[F.timestamp_seconds(c).cast("timestamp_ntz").alias(n) for c, n in (("a", "session_start"), ("b", "session_end"))]
    )
    for r in sessions.assign_session(df, told, "ts", ["p"]).collect():
        inside = [i for p, i, a, b in found if p == r.p and r.s is not None and a <= r.s <= b]
        assert r.session_id == (inside[0] if inside else None)
