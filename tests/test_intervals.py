import datetime as dt
import random

import pytest

from tidemark.operators.scd2 import scd2_merge
from tidemark.sources import intervals, versions

SCHEMA = "k string, v string, grp string, _valid_from timestamp_ntz, _valid_to timestamp_ntz"


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def loads(seed, n=5):
    """Snapshots: each group is loaded on most days, keys come and go and return."""
    rng = random.Random(seed)
    out = []
    for d in range(n):
        rows = []
        for grp in ("g", "h", None):
            if rng.random() < 0.8:
                rows += [(f"{k}{grp}", str(k), grp, at(d), at(d)) for k in range(6) if rng.random() < 0.7]
        out.append(rows)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_stored_table_equals_the_merge_of_all_rows(spark, tmp_path, rows, seed):
    path, whole = str(tmp_path / "t"), None
    for load in loads(seed):
        current = spark.createDataFrame(load, SCHEMA)
        merged = scd2_merge(whole, current, "k", ["v", "grp"], "grp", pass_closed=False) if whole is not None else current
        whole = spark.createDataFrame(merged.collect(), SCHEMA)
        intervals.merge_into(path, current, "k", ["v", "grp"], "grp")
        again = intervals.merge_into(path, current, "k", ["v", "grp"], "grp")
        stored = intervals.read_intervals(spark, path)
        assert rows(stored) == rows(whole.select(stored.columns))
    assert again == 10 and rows(intervals.read_intervals(spark, path, 2)) == sorted(loads(seed)[0], key=repr)


def test_only_the_open_part_is_read_once(spark, tmp_path):
    path = str(tmp_path / "t")
    history = [(f"k{i}", "v", "g", at(i), at(i)) for i in range(50)]
    assert intervals.store_intervals(spark.createDataFrame(history, SCHEMA), path, "grp") == 1
    content = versions.committed(spark, path)[1]
    current = spark.createDataFrame([("k49", "v", "g", at(50), at(50)), ("new", "v", "g", at(50), at(50))], SCHEMA)
    merged, seen = intervals.merged_open(spark, content, current, "k", ["v", "grp"], "grp")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "[k#" in line]
    files = [f for f in merged.inputFiles() if "/rows/" in f]
    assert len(scans) == 1 and files and all("_tm_part=open" in f for f in files)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert intervals.merge_into(path, current, "k", ["v", "grp"], "grp") == 2
    assert {p: p.stat().st_mtime_ns for p in before} == before
    new = versions.committed(spark, path)[2]
    assert spark.read.schema(SCHEMA).parquet(f"{new}/rows/_tm_part=open").count() == 2
    closed = spark.read.schema(SCHEMA).parquet(f"{content}/rows/_tm_part=closed").collect()
    assert len(closed) == 49 and not any("_tm_part=closed" in str(p) for p in (tmp_path / "t").rglob("*") if new in str(p))
    found = {r.k: (r._valid_from, r._valid_to) for r in intervals.read_intervals(spark, path).collect()}
    assert len(found) == 51 and found["k49"] == (at(49), at(50)) and found["k3"] == (at(3), at(3))


def test_a_load_that_another_came_before_is_merged_anew(spark, tmp_path, monkeypatch, rows):
    path = str(tmp_path / "t")
    load = {g: spark.createDataFrame([(f"k{g}", "v", g, at(1), at(1))], SCHEMA) for g in ("a", "b", "c")}
    intervals.merge_into(path, load["a"], "k", ["v", "grp"], "grp")
    really, others = versions.commit, ["b"]

    def slower(*args):
        if others:
            intervals.merge_into(path, load[others.pop()], "k", ["v", "grp"], "grp")
        return really(*args)

    monkeypatch.setattr(versions, "commit", slower)
    assert intervals.merge_into(path, load["c"], "k", ["v", "grp"], "grp") == 3
    assert rows(intervals.read_intervals(spark, path), "k") == [("ka",), ("kb",), ("kc",)]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        intervals.read_intervals(spark, path)
    none = spark.createDataFrame([], SCHEMA)
    intervals.merge_into(path, spark.createDataFrame([("k", None, None, at(1), None)], SCHEMA), "k", ["v", "grp"], "grp")
    intervals.merge_into(path, none, "k", ["v", "grp"], "grp")
    assert [tuple(r) for r in intervals.read_intervals(spark, path).collect()] == [("k", None, None, at(1), None)]
