import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import labels
from tidemark.operators.labels import Step, rule_cascade
from tidemark.operators.scale import bloom_filter, may_hold

RULES = "label string, kind string, pattern string"


def day(n):
    return dt.date(2024, 1, n)


def cascade(spark, texts, rules, steps):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    out = rule_cascade(df, "text", spark.createDataFrame(rules, RULES), steps, "none")
    return dict(out.collect())


CASES = [
    # test, pattern, texts that fit, texts that do not
    ("phrase", "bin", ["a bin b", "Bin b", "a BIN", "a  bin b"], ["bin", "bing b", "a cabin"]),
    ("phrase", "s/o x", ["a s/o X b", "s/o x b", "a s/o x"], ["s/o x", "a s/o y", "a s/o xy"]),
    ("start", "raj", ["Raj", "raj b", "RAJ b"], ["rajan", "b raj"]),
    ("start", "de la", ["de la x", "De La x"], ["de la", "de x", "x de la"]),
    ("start_mixed", "raj", ["Raj", "raj b"], ["RAJ", "RAJ b", "rajan", "b raj", "1 raj"]),
    ("end_mixed", "din", ["a Uddin", "din", "Din"], ["a UDDIN", "uddin a", "dins"]),
    ("word_mixed", "ali", ["Ali b", "b Ali", "a ALI c", "a ali c", "ali"],
     ["ALI b", "b ALI", "alim c", "a alim c"]),
    ("word_mixed", "al bo", ["a al bo c"], ["al bo c", "a al bo"]),
    ("capital_word", "tan", ["a TAN b", "TAN"], ["Tan b", "TAN1 b", "tan"]),
    ("capital_word", "o", [], ["O b", "a O"]),
    ("first_or_last_word", "tan", ["tan b", "b TAN", "Tan"], ["a tan b", "tank b"]),
    ("first_word", "tan", ["tan b", "TAN"], ["a tan"]),
    ("last_word", "tan", ["a tan"], ["tan", "tan a"]),
    ("any_word", "tan", ["a tan b", "TAN"], ["a tanb", "tan-b"]),
    ("phrase", "a_b", ["x a_b"], ["x axb"]),
    ("phrase", "50%", ["x 50%"], ["x 500"]),
]


@pytest.mark.parametrize("test, pattern, fits, fails", CASES)
def test_each_test(spark, test, pattern, fits, fails):
    rules = [("L", "k", pattern), ("M", "k", "zzz"), ("L", "other", "b")]
    got = cascade(spark, [*fits, *fails, None, ""], rules, [Step("L", "k", test)])
    assert {t for t, label in got.items() if label == "L"} == set(fits)
    assert set(got.values()) <= {"L", "none"}


def test_the_first_step_wins(spark):
    rules = [("A", "w", "x"), ("B", "w", "y"), ("B", "p", "x")]
    steps = [Step("B", "p", "first_word"), Step("A", "w", "any_word"), Step("B", "w", "any_word")]
    got = cascade(spark, ["y x", "x y", "y", "q"], rules, steps)
    assert got == {"y x": "A", "x y": "B", "y": "B", "q": "none"}


def test_rows_with_equal_texts_are_all_kept(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id int, text string")
    rules = spark.createDataFrame([("A", "w", "x")], RULES)
    out = rule_cascade(df, "text", rules, [Step("A", "w", "any_word")], "none")
    assert sorted((r.id, r.label) for r in out.collect()) == [(1, "A"), (2, "A"), (3, "none")]


def test_no_rules(spark):
    assert cascade(spark, ["x"], [("Z", "z", "z")], [Step("A", "w", "phrase")]) == {"x": "none"}


def test_long_text(spark):
    text = " ".join(f"w{i}" for i in range(20_000)) + " needle in hay"
    got = cascade(spark, [text, "w1"], [("A", "p", "needle in")], [Step("A", "p", "phrase")])
    assert got[text] == "A" and got["w1"] == "none"


def test_layers(spark):
    history = spark.createDataFrame(
        [
            ("ann", "Mx.", day(9), True), ("ann", "Ms", day(2), False), ("ann", "Mr", day(1), False),
            ("bo", "Mr.", day(9), True), ("cy", "Dr", day(9), True), ("di", "Dr", day(9), True),
            ("ed", "Dr", day(9), True), ("ed", "Ms Dr", day(9), True),
        ],
        "name string, title string, effective_to date, is_latest boolean",
    )
    vocabulary = {"m": ["mr"], "f": ["ms", "ms dr"]}
    names = spark.createDataFrame([(n,) for n in ("ann", "bo", "cy", "di d/o x", "ed", "q")], "name string")
    layers = [
        ("current", labels.current_label(history, "name", "title", vocabulary)),
        ("historical", labels.historical_label(history, "name", "title", vocabulary)),
        ("start", labels.label_of_pattern("name", [(r"^cy", "m"), (r"^c", "f")])),
        ("token", labels.label_of_pattern("name", [(r"(?:^|\s)d/o(?:\s|$)", "f")])),
    ]
    got = labels.layered_label(names, "name", layers).collect()
    assert {r.name: (r.label, r.label_source) for r in got} == {
        "ann": ("f", "historical"), "bo": ("m", "current"), "cy": ("m", "start"),
        "di d/o x": ("f", "token"), "ed": ("f", "current"), "q": (None, None),
    }


def test_one_exchange_of_rows_for_any_number_of_layer_tables(spark):
    """Tables are reduced to one row per key, and the rows are joined once."""
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("text"))
    tables = [
        (f"layer{i}", spark.range(i, 100, 3).select(F.col("id").cast("string").alias("k"), F.lit(f"v{i}").alias("label")))
        for i in range(4)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            labels.layered_label(df, "k", tables[:n])._jdf.queryExecution().executedPlan().toString() for n in (1, 4)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [p.count("SortMergeJoin") for p in plans] == [1, 1]
    # of the rows, of the labels by key, and of what they are reduced to
    assert [p.count("Exchange hashpartitioning") for p in plans] == [3, 3]


def test_layers_of_columns_and_tables_in_any_order(spark):
    df = spark.createDataFrame([(k, None if k == "d" else "own") for k in "abcd"] + [(None, None)], "k string, c string")
    first = spark.createDataFrame([("a", "x"), ("b", None), (None, "z")], "k string, label string")
    last = spark.createDataFrame([("a", "y"), ("b", "q"), ("b", "p"), ("d", "w")], "k string, label string")
    out = labels.layered_label(df, "k", [("first", first), ("column", F.col("c")), ("last", last)])
    assert {r.k: (r.label, r.label_source) for r in out.collect()} == {
        "a": ("x", "first"), "b": ("own", "column"), "c": ("own", "column"), "d": ("w", "last"), None: (None, None),
    }
    other = labels.layered_label(df, "k", [("last", last), ("column", F.col("c"))])
    assert {r.k: (r.label, r.label_source) for r in other.collect()}["b"] == ("p", "last")
    none = labels.layered_label(df, "k", [("column", F.col("c"))])
    assert none.filter("label_source = 'column'").count() == 3


def test_probes_that_no_rule_has_are_not_shuffled(spark):
    """With rules that aren't broadcast, the filter works before the exchange."""
    texts = spark.range(3000).select(F.concat(F.lit("word"), "id", F.lit(" tail"), "id").alias("text"))
    rules = spark.createDataFrame([("A", "word", f"word{i}") for i in range(0, 50)], RULES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = rule_cascade(texts, "text", rules, [Step("A", "word", "any_word")], "none")
        assert out.filter("label = 'A'").count() == 50
        out.collect()
        plan = out._jdf.queryExecution().executedPlan()
        stages, probes = [plan], []
        while stages:
            node = stages.pop()
            children = node.children()
            stages += [children.apply(i) for i in range(children.size())]
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                stages.append(node.executedPlan())
            elif "QueryStage" in node.nodeName():
                stages.append(node.plan())
            elif node.nodeName() == "Exchange" and "probe" in node.output().mkString(",") and "_text" in node.output().mkString(","):
                probes.append(node.metrics().apply("shuffleRecordsWritten").value())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert probes and 50 <= min(probes) < 300  # of 6,000


def test_filter_holds_all_its_keys(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    held = bloom_filter(keys, ["k"])
    found = spark.range(20000).select("id", may_hold(held, F.xxhash64(F.col("id").cast("string"))).alias("may"))
    assert found.filter("id < 5000 and may").count() == 5000
    assert found.filter("id >= 5000 and may").count() < 300
    none = bloom_filter(keys.limit(0), ["k"])
    assert keys.filter(may_hold(none, F.xxhash64("k"))).count() == 0

