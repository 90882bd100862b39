import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import attributes, dims, names, quality, staging
from tidemark.operators import hierarchy
from tidemark.operators.hierarchy import bucketed, flatten_hierarchy, walk_hierarchy
from tidemark.operators.scd2 import scd2_merge
from tidemark.operators.snapshots import load_manifest, stamp_snapshot
from tidemark.session import forget_stored, stored
from tidemark.sources import tables, versions
from tidemark.streaming.loads import append_stream, arriving_loads


def day(n):
    return dt.date(2024, 1, n)


def test_walk_stops_at_cycles_and_repeats_shared_nodes(spark, rows):
    edges = spark.createDataFrame(
        [("r", "a"), ("r", "b"), ("a", "c"), ("b", "c"), ("c", "r"), ("x", "y")], "p string, n string"
    )
    roots = spark.createDataFrame([("r",)], "n string")
    got = walk_hierarchy(edges, roots, "p", "n")
    assert rows(got, "node", "parent", "depth") == sorted(
        [("r", None, 0), ("a", "r", 1), ("b", "r", 1), ("c", "a", 2), ("c", "b", 2)], key=repr
    )


def test_a_level_shuffles_its_nodes_only(spark):
    """Stored edges lie by parent: only the nodes that were reached are exchanged."""
    edges = spark.createDataFrame([(f"n{i}", f"n{2 * i + j}") for i in range(1, 40) for j in (0, 1)], "_parent string, _child string")
    level = spark.createDataFrame([("n1", None, 0, ["n1"])], "node string, parent string, depth int, path array<string>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(edges, "_parent") as links:
            name = links.inputFiles()[0]
            below = hierarchy._children(level, links, False, {})
            assert sorted(r.node for r in below.collect()) == ["n2", "n3"]
            plan = below._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    links_side = plan.split("SortMergeJoin")[1].split("FileScan")[0].rsplit(":- ", 1)[-1]
    assert "Exchange hashpartitioning(node" in plan and name and "Exchange hashpartitioning(_parent" not in links_side
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_flatten_joins_children_in_order(spark, rows):
    nodes = spark.createDataFrame(
        [("k", None, "Top", "/k", 0)] + [(f"c{i}", "k", f"C{i}", f"/c{i}", i) for i in (2500, 3, 1001)],
        "key string, parent string, name string, link string, ordinal long",
    )
    got = rows(flatten_hierarchy(nodes))
    assert (None, "Top", "/k", "C3, C1001, C2500") in got
    assert ("Top", "C3", "/c3", "") in got and len(got) == 4


def test_append_keeps_earlier_loads(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "n string")
    path = str(tmp_path / "raw")
    for d in (1, 8):
        tables.append_table(stamp_snapshot(df, "g", dt.datetime(2024, 1, d, 5)), path)
    stored = tables.read_table(spark, path)
    assert stored.count() == 2
    assert [r[0] for r in stored.select("snapshot_date").distinct().orderBy("snapshot_date").collect()] == [
        day(1), day(8),
    ]


def test_a_repeated_load_changes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "raw")

    def load(group, d, names):
        df = spark.createDataFrame([(n,) for n in names], "n string")
        tables.append_table(stamp_snapshot(df, group, dt.datetime(2024, 1, d, 5)), path)

    load("g", 1, "abc")
    load("h", 1, "x")
    load("g", 2, "d")
    once = rows(tables.read_table(spark, path))
    load("g", 1, "abc")
    load("g", 2, "d")
    assert rows(tables.read_table(spark, path)) == once
    manifest = load_manifest({"raw": tables.read_table(spark, path)})
    assert rows(manifest, "group_name", "num_rows") == [("g", 1), ("g", 3), ("h", 1)]
    load("g", 1, "ab")  # the load corrected
    assert [r.n for r in tables.read_table(spark, path).filter("group_name = 'g'").orderBy("n").collect()] == ["a", "b", "d"]
    load("k", 3, "")
    assert tables.read_table(spark, path).count() == 4


def test_loads_without_time_or_group(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("a", None, None), ("b", "g", None)], "n string, group_name string, _accessed_at timestamp_ntz")
    for _ in range(2):
        tables.append_table(df, path)
    assert tables.read_table(spark, path).count() == 2
    ungrouped = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2))], "n string, _accessed_at timestamp_ntz")
    for _ in range(2):
        tables.append_table(ungrouped, path + "2")
    assert tables.read_table(spark, path + "2").count() == 2


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(1), path)
    meet, really = threading.Barrier(3), versions.newest
    first = threading.local()

    def together(*args):
        found = really(*args)
        if not getattr(first, "met", False):
            first.met = True
            meet.wait(60)  # all writers have seen the same last version
        return found

    monkeypatch.setattr(versions, "newest", together)
    with ThreadPoolExecutor(3) as pool:
        made = sorted(pool.map(lambda n: tables.replace_table(spark.range(n), path), (11, 12, 13)))
    monkeypatch.setattr(versions, "newest", really)
    assert made == [2, 3, 4]
    assert sorted(tables.read_current(spark, path, v).count() for v in made) == [11, 12, 13]
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_note")]
    assert all(len([p for p in (tmp_path / "t/versions" / str(v)).iterdir() if p.is_dir()]) == 0 for v in made)


def test_a_writer_that_another_came_before(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.replace_table(spark.range(1), path, expected=0) == 1
    assert tables.replace_table(spark.range(2), path, expected=1) == 2
    with pytest.raises(versions.ConcurrentChange):
        tables.replace_table(spark.range(3), path, expected=1)
    assert tables.read_current(spark, path).count() == 2


def test_old_versions_and_lost_contents_go(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(7).write.parquet(versions.new_content(path))  # a run lost before its commit
    for n in range(1, 5):
        assert tables.replace_table(spark.range(n), path, keep=2) == n
    assert list(versions.committed(spark, path)) == [3, 4]
    assert tables.read_current(spark, path, 3).count() == 3 and tables.read_current(spark, path).count() == 4
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path, 2)
    assert len(list((tmp_path / "t").glob("content-*"))) == 3
    versions.drop_old(spark, path, 1, orphan_hours=0)
    assert len(list((tmp_path / "t").glob("content-*"))) == 1 and tables.replace_table(spark.range(1), path) == 5


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "scd")
    assert tables.replace_table(spark.range(3), path) == 1
    assert tables.replace_table(tables.read_current(spark, path).filter("id > 0"), path) == 2
    assert sorted(r.id for r in tables.read_current(spark, path).collect()) == [1, 2]
    assert tables.read_current(spark, path, version=1).count() == 3
    spark.range(9).write.parquet(f"{path}/version=3")  # a run lost before its version counted
    assert tables.read_current(spark, path).count() == 2
    assert tables.replace_table(spark.range(5), path) == 3
    assert tables.read_current(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, str(tmp_path / "none"))


def test_rules_file(spark, tmp_path, rows):
    (tmp_path / "rules.csv").write_text('label,kind,pattern,notes\nA,word,"x, y",why\n')
    assert rows(tables.read_rules(spark, str(tmp_path / "rules.csv"))) == [("A", "word", "x, y", "why")]


def deliver(spark, folder, time, n, files=3):
    rows = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("v").alias("v"))
    rows.repartition(files).write.parquet(f"{folder}/load={time}")


def test_stream_appends_each_file_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "raw")
    for i, n in enumerate((2, 5)):
        deliver(spark, folder, f"2024-05-0{i + 1} 10:30:00", n)
        loads = arriving_loads(spark, folder, "k string, v string", "g")
        append_stream(loads, path, str(tmp_path / "cp")).awaitTermination(120)
    times = spark.read.parquet(path).filter("group_name = 'g'").groupBy("_accessed_at").count().collect()
    assert {r[0]: r[1] for r in times} == {dt.datetime(2024, 5, 1, 10, 30): 2, dt.datetime(2024, 5, 2, 10, 30): 5}


def test_a_delivery_read_in_several_batches_is_one_load(spark, tmp_path):
    """Files that come late still belong to their delivery, and unchanged loads add no interval."""
    folder, path = tmp_path / "in", str(tmp_path / "raw")
    late = tmp_path / "late"
    late.mkdir()
    for time in ("2024-05-01T10:30:00", "2024-05-02T10%3A30%3A00"):
        deliver(spark, str(folder), time, 100, files=4)
        parts = sorted((folder / f"load={time}").glob("*.parquet"))
        for part in parts[2:]:
            part.rename(late / part.name)
        for step in (0, 1):
            for part in parts[2:] if step else []:
                (late / part.name).rename(part)
            loads = arriving_loads(spark, str(folder), "k string, v string", "g")
            append_stream(loads, path, str(tmp_path / "cp")).awaitTermination(120)
    raw = spark.read.parquet(path)
    assert raw.select("_accessed_at").distinct().count() == 2 and raw.count() == 200
    assert load_manifest({"raw": raw}).count() == 2
    interval = raw.select("k", "v", "group_name", F.col("_accessed_at").alias("_valid_from"), F.col("_accessed_at").alias("_valid_to"))
    first, second = (interval.filter(F.dayofmonth("_valid_from") == d) for d in (1, 2))
    merged = scd2_merge(first, second, "k", ["v", "group_name"], "group_name")
    assert merged.count() == 100
    assert merged.select("_valid_to").distinct().collect()[0][0] == dt.datetime(2024, 5, 2, 10, 30)


def test_a_file_outside_a_load_folder_fails(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(2).select(F.lit("k").alias("k"), F.lit("v").alias("v")).write.parquet(folder)
    loads = arriving_loads(spark, folder, "k string, v string", "g")
    with pytest.raises(Exception, match="no load="):
        append_stream(loads, str(tmp_path / "raw"), str(tmp_path / "cp")).awaitTermination(120)


def test_stored_sides_are_removed(spark, tmp_path):
    held = stored(spark.range(5))
    (path,) = {f.rsplit("/", 1)[0] for f in held.inputFiles()}
    assert held.count() == 5 and Path(path.removeprefix("file:")).exists()
    forget_stored()
    assert not Path(path.removeprefix("file:")).exists()


def test_manifest(spark, rows):
    at = dt.datetime(2024, 1, 1)
    df = stamp_snapshot(spark.range(3).drop("id").withColumn("x", F.lit(1)), "g", at)
    took = spark.createDataFrame([("g", at, 1.5)], "group_name string, _accessed_at timestamp_ntz, extraction_duration_seconds double")
    columns = ["table_name", "group_name", "num_rows", "extraction_duration_seconds"]
    assert rows(load_manifest({"a": df, "b": df}, durations=took), *columns) == [
        ("a", "g", 3, 1.5), ("b", "g", 3, 1.5),
    ]
    assert rows(load_manifest({"a": df}), *columns) == [("a", "g", 3, None)]
    empty = df.limit(0)
    assert rows(load_manifest({"a": df, "b": empty}, durations=took), *columns) == [
        ("a", "g", 3, 1.5), ("b", "g", 0, 1.5),
    ]


def test_project_rename(spark):
    df = staging.project_rename(spark.range(1), {"id": "key"}, view="stage_test")
    assert df.columns == ["key"] and spark.table("stage_test").columns == ["key"]


@pytest.mark.parametrize("few", [True, False])
def test_flag_latest(spark, rows, few):
    df = spark.createDataFrame(
        [("g", 1), ("g", 3), ("g", 3), (None, 2), (None, 1), ("h", None)], "g string, t int"
    )
    got = staging.flag_latest(df, "t", ["g"], few_groups=few)
    assert rows(got) == sorted(
        [("g", 1, False), ("g", 3, True), ("g", 3, True), (None, 2, True), (None, 1, False),
         ("h", None, None)], key=repr,
    )


def test_keep_longest(spark, rows):
    df = spark.createDataFrame(
        [("k", "Dr", 1), ("k", "Assoc Prof", 2), ("k", "Assoc Prof", 1), ("k", None, 0),
         ("n", None, 1), ("t", "bb", 1), ("t", "aa", 9)],
        "k string, v string, o int",
    )
    assert rows(staging.keep_longest(df, ["k"], "v")) == [
        ("k", "Assoc Prof", 1), ("n", None, 1), ("t", "aa", 9),
    ]


def test_drop_sentinels(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("-", "x"), (None, "x"), ("b", "")], "n string, e string")
    assert rows(staging.drop_sentinels(df, {"n": ["-"], "e": [""]})) == [("a", "x")]


def test_canonicalise(spark, rows):
    df = spark.createDataFrame([("Mr A",), ("B",), ("C",), (None,)], "raw string")
    mapping = spark.createDataFrame([("Mr A", "A"), ("Mr A", "A"), ("B", "")], "r string, c string")
    assert rows(names.canonicalise(df, mapping, "raw", "r", "c", "n")) == sorted(
        [("Mr A", "A"), ("B", "B"), ("C", "C"), (None, None)], key=repr
    )
    assert rows(names.canonicalise(df, mapping, "raw", "r", "c", "n", fallback=False)) == sorted(
        [("Mr A", "A"), ("B", ""), ("C", None), (None, None)], key=repr
    )
    assert ("B", "") in rows(
        names.canonicalise(df, mapping, "raw", "r", "c", "n", empty_is_missing=False)
    )


def test_attribute_history_drops_null_keys(spark, rows):
    df = spark.createDataFrame(
        [("e", "Dr", day(2), day(3)), ("e", "Dr", day(1), day(2)), ("e", None, day(1), day(9)),
         (None, "Dr", day(1), day(9))],
        "email string, prefix string, _valid_from date, _valid_to date",
    )
    got = names.attribute_history(df, ["email", "prefix"])
    assert rows(got) == [("e", "Dr", day(1), day(3))]


def test_values_of_entities(spark, rows):
    df = spark.createDataFrame(
        [("a", "v1", day(1)), ("a", "v2", day(2)), ("a", "v3", day(2)), ("b", "v3", day(3)),
         ("b", "v4", day(1)), ("c", "v3", day(1)), ("a", "v1", day(1)), ("d", "v5", day(1)),
         ("e", "v5", day(1)), (None, "v6", day(1))],
        "e string, v string, d date",
    )
    assert rows(attributes.shared_values(df, "e", "v")) == [("v3", 3), ("v5", 2)]
    assert rows(attributes.latest_private_value(df, "e", "v", "d")) == [
        ("a", "v2", day(2), True), ("b", "v4", day(1), True),
    ]
    assert rows(attributes.possible_duplicates(df, "e", "v")) == [("v5", 2, ["d", "e"])]
    assert rows(attributes.possible_duplicates(df, "e", "v", 3)) == [("v3", 3, ["a", "b", "c"])]
    assert rows(attributes.possible_duplicates(df, "e", "v", 1), "v", "entities") == [
        ("v1", ["a"]), ("v2", ["a"]), ("v4", ["b"]),
    ]


def test_entity_dim(spark, rows):
    people = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "n string")
    flags = spark.createDataFrame([("A", True)], "n string, has boolean")
    got = dims.entity_dim(people, "n", [flags], {"has": False})
    assert rows(got, "n", "has") == [("A", True), ("B", False)]
    checks = [quality.Check("entity_key", unique=True, not_null=True), quality.Check("n", unique=True)]
    assert all(r.failures == 0 for r in quality.run_checks(got, checks).collect())


def test_unit_dim(spark):
    df = spark.createDataFrame(
        [("Old", None, "g", "/u", 1), ("New", None, "g", "/u", 2), ("X", "p", "g", "/x", 1),
         ("Y", None, "h", "/u", 1)],
        "name string, parent string, grp string, url string, ts int",
    )
    got = {(r.grp, r.url): r for r in dims.unit_dim(df, "name", "parent", "grp", "url", "ts").collect()}
    u = got["g", "/u"]
    assert (u.latest_name, u.names, u.count_names, u.effective_from, u.is_active) == (
        "New", ["New", "Old"], 2, 1, True,
    )
    assert not got["g", "/x"].is_active and got["h", "/u"].is_active


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3)], "k string, v int")
    got = quality.run_checks(
        df,
        [
            quality.Check("k", unique=True, not_null=True, accepted=["a"]),
            quality.Check("v", unique=True, accepted=[2], where=F.col("v") < 3),
        ],
    )
    assert {(r.column_name, r.rule): r.failures for r in got.collect()} == {
        ("k", "unique"): 1, ("k", "not_null"): 1, ("k", "accepted_values"): 1,
        ("v", "unique"): 1, ("v", "accepted_values"): 1,
    }
    empty = quality.run_checks(df.limit(0), [quality.Check("k", not_null=True, unique=True)])
    assert [r.failures for r in empty.collect()] == [0, 0]


def test_checks_read_the_table_twice_at_most(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 0.0, None), ("b", 1, -0.0, "x"), (None, 2, 1.5, "y"), ("b", None, None, "y")], "s string, i int, d double, t string"
    )
    every = [quality.Check(c, not_null=True) for c in df.columns]
    plan = quality.run_checks(df, every)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    more = [quality.Check(c, unique=True, accepted=[df.first()[c]] if c != "t" else ["x"], not_null=True) for c in df.columns]
    plan = quality.run_checks(df, more)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2
    got = {(r.column_name, r.rule): r.failures for r in quality.run_checks(df, more).collect()}
    assert got == {
        ("s", "not_null"): 1, ("i", "not_null"): 1, ("d", "not_null"): 1, ("t", "not_null"): 1,
        ("s", "unique"): 1, ("i", "unique"): 1, ("d", "unique"): 1, ("t", "unique"): 1,
        ("s", "accepted_values"): 1, ("i", "accepted_values"): 1, ("d", "accepted_values"): 1, ("t", "accepted_values"): 1,
    }
    assert quality.run_checks(df, []).count() == 0
    none = quality.run_checks(df.limit(0), more)
    assert rows(none.select("failures").distinct()) == [(0,)]
