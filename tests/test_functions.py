import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import remap_dates
from tidemark.functions.keys import NULL_TOKEN, content_key, surrogate_key
from tidemark.functions.measures import band, share
from tidemark.functions.text import matches_any, shares_word, token_features
from tidemark.functions.titles import (
    leading_title, strip_affixes, strip_leading_titles, trailing_suffix,
)


def one(spark, expression, value):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expression("x").alias("y")).first()[0]


@pytest.mark.parametrize(
    "name, title",
    [
        ("John SMITH", None),
        ("Mr John SMITH", "Mr"),
        ("MR. John SMITH", "MR"),
        ("Dr. ", "Dr"),
        ("A.Prof John", None),
        ("M.r. John", "M.r"),
        ("Assoc Prof John", "Assoc Prof"),
        ("Unknown Prof. John", "Unknown Prof"),
        ("Col (Ret) (Dr) John", "Col (Ret) (Dr)"),
        ("Mary Jane (Mdm) Tan", "Mary Jane (Mdm)"),
        ("Adj  Asst   Prof. John", "Adj Asst Prof"),
        ("Dr John", "Dr"),
        ("Drake John", None),
        ("Mr", "Mr"),
        ("John Prof", "John Prof"),
        ("   ", None),
        ("", None),
        (None, None),
    ],
)
def test_leading_title(spark, name, title):
    assert one(spark, leading_title, name) == title


def test_leading_title_exclusions_hold_for_the_third_word_only(spark):
    def excluded(col):
        return leading_title(col, exclude=["Mary Tan (MDM)", "Dr Prof (MR)"])

    assert one(spark, leading_title, "Mary Tan (MDM)") == "Mary Tan (MDM)"
    assert one(spark, excluded, "Mary Tan (MDM)") is None
    assert one(spark, excluded, "Dr Prof (MR)") == "Dr Prof"


@pytest.mark.parametrize(
    "name, suffix",
    [
        ("John SMITH", None),
        ("John SMITH PBM", "PBM"),
        ("John, PPA (E), PBM", "PPA (E), PBM"),
        ("John PKO", "PKO"),
        ("SPBX John", "PBX John"),
        ("John pbm", None),
        ("John PBM\nBBM", "PBM\nBBM"),
        ("", None),
        (None, None),
    ],
)
def test_trailing_suffix(spark, name, suffix):
    assert one(spark, trailing_suffix, name) == suffix


def test_trailing_suffix_whole_word(spark):
    assert one(spark, lambda c: trailing_suffix(c, whole_word=True), "SPBX PBM") == "PBM"


@pytest.mark.parametrize(
    "name, prefix, suffix, rest",
    [
        ("Mr John, PBM", "Mr", "PBM", "John"),
        ("Dr. John", "Dr", None, "John"),
        ("Adj  Prof John", "Adj Prof", None, "John"),
        ("Adj   Prof John", "Adj Prof", None, "f John"),
        ("John,,", None, None, "John"),
        (" John ", " ", "", "John"),
        ("PBM", None, "PBM", ""),
        ("Mr", "Mr", None, ""),
        (None, None, None, None),
    ],
)
def test_strip_affixes(spark, name, prefix, suffix, rest):
    df = spark.createDataFrame([(name, prefix, suffix)], "n string, p string, s string")
    assert df.select(strip_affixes("n", "p", "s")).first()[0] == rest


@pytest.mark.parametrize(
    "name, rest",
    [("mr. John", "John"), ("Mr John", "John"), ("Adj A/Prof. Jo", "Jo"), ("Merry Jo", "Merry Jo")],
)
def test_strip_leading_titles(spark, name, rest):
    assert one(spark, strip_leading_titles, name) == rest


def test_token_features(spark):
    df = spark.createDataFrame([("Jackson CHUA B Keng OO",), ("",), ("a  b",)], "x string")
    features = token_features("x")
    got = [tuple(r) for r in df.select(*features.values()).collect()]
    assert got == [
        ("Jackson", "OO", ["Jackson", "CHUA", "B", "Keng", "OO"], 5, "CHUA OO"),
        ("", "", [""], 1, None),
        ("a", "b", ["a", "", "b"], 3, None),
    ]


@pytest.mark.parametrize(
    "old, new, alike",
    [
        ("TAN Ah Kow", "Ah Kow Tan", True),
        ("Maximilian X", "Maxmilian", False),
        ("Maximilian X", "Maxim Y", True),
        ("A B", "A B C", False),
        ("O_ X", "OX Y", False),
        (None, "A", False),
        ("AB", None, False),
    ],
)
def test_shares_word(spark, old, new, alike):
    df = spark.createDataFrame([(old, new)], "o string, n string")
    assert df.select(shares_word("o", "n")).first()[0] is alike


@pytest.mark.parametrize(
    "value, pattern",
    [
        ("director@x", "director@%"), ("the head@x", "%head@%"), ("a_qsm@b", "%_qsm@%"),
        ("a.b", "a.b"), ("line\nend", "l%d"), ("abc", "a_c"), ("x", "%"), ("", ""),
        ("xdirector@x", "director@%"), ("_qsm@b", "%_qsm@%"), ("qsm@b", "%_qsm@%"),
        ("abc\n", "abc"), ("a+b", "a+b"), ("acb", "a.b"), ("", "_"),
    ],
)
def test_matches_any_is_like(spark, value, pattern):
    df = spark.createDataFrame([(value,)], "x string")
    ours, like = df.select(matches_any("x", [pattern]), F.col("x").like(pattern)).first()
    assert ours == like


def test_matches_any_of_several_and_of_none(spark):
    df = spark.createDataFrame([("CEO@x",), ("me@x",), (None,)], "x string")
    got = df.select(matches_any("x", ["http%", "ceo@%"]), matches_any("x", [])).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, False), (None, False)]


def test_remap_dates(spark):
    moves = {dt.date(2024, 5, 6): dt.date(2024, 5, 7)}
    df = spark.sql(
        "select timestamp_ntz'2024-05-06 23:00:00' a, timestamp_ntz'2024-05-08 01:00:00' b, "
        "cast(null as date) c"
    )
    got = df.select(*[remap_dates(c, moves) for c in "abc"]).first()
    assert tuple(got) == (dt.date(2024, 5, 7), dt.date(2024, 5, 8), None)
    assert df.select(remap_dates("a", {})).first()[0] == dt.date(2024, 5, 6)


def test_keys(spark):
    df = spark.createDataFrame([("ab", "c", None), ("a", "bc", "")], "x string, y string, z string")
    content = [r[0] for r in df.select(content_key("x", "y", "z")).collect()]
    assert content == [hashlib.md5(b"abc").hexdigest()] * 2
    surrogate = [r[0] for r in df.select(surrogate_key("x", "z")).collect()]
    assert surrogate[0] == hashlib.md5(f"ab-{NULL_TOKEN}".encode()).hexdigest()
    assert surrogate[1] == hashlib.md5(b"a-").hexdigest()


def test_band_and_share(spark):
    df = spark.createDataFrame([(80.0,), (79.9,), (50.0,), (49.9,), (0.0,)], "p double")
    assert [r[0] for r in df.select(band("p")).collect()] == [
        "high", "medium", "medium", "low", "low",
    ]
    zero = spark.range(1).select(share(F.lit(0), F.lit(0)), share(F.lit(1), F.lit(8)))
    assert tuple(zero.first()) == (0.0, 12.5)
