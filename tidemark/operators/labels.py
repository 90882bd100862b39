"""Labels from ordered layers and from rule tables. All vocabularies are the caller's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import token_features
from tidemark.operators.scale import bloom_filter, may_hold, skew_join
from tidemark.session import stored


def label_of_value(value: Column | str, vocabulary: Mapping[str, Sequence[str]]) -> Column:
    """Label whose values hold the lower-cased, dot-free value; null if none does."""
    value = F.col(value) if isinstance(value, str) else value
    plain = F.replace(F.lower(value), F.lit("."), F.lit(""))
    return F.coalesce(
        *[F.when(plain.isin(*values), label) for label, values in vocabulary.items()]
    )


def label_of_pattern(text: Column | str, patterns: Sequence[tuple[str, str]]) -> Column:
    """Label of the first (pattern, label) whose pattern is found in the lower-cased text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        *[F.when(F.regexp_like(F.lower(text), F.lit(p)), label) for p, label in patterns]
    )


def current_label(
    history: DataFrame, key: str, value: str, vocabulary: Mapping[str, Sequence[str]],
    is_latest: str = "is_latest",
) -> DataFrame:
    """Per key, the label of the longest of its latest values."""
    latest = history.filter(F.col(is_latest))
    longest = F.max_by(value, F.struct(F.length(value), value))
    return latest.groupBy(key).agg(longest.alias("_value")).select(
        key, label_of_value("_value", vocabulary).alias("label")
    )


def historical_label(
    history: DataFrame, key: str, value: str, vocabulary: Mapping[str, Sequence[str]],
    until: str = "effective_to",
) -> DataFrame:
    """Per key, the label of the most recent value that has one."""
    labelled = history.withColumn("_label", label_of_value(value, vocabulary))
    return (
        labelled.filter(F.col("_label").isNotNull())
        .groupBy(key)
        .agg(F.max_by("_label", F.struct(until, value)).alias("label"))
    )


def layered_label(
    df: DataFrame,
    key: str,
    layers: Sequence[tuple[str, DataFrame | Column]],
    label: str = "label",
    source: str = "label_source",
) -> DataFrame:
    """Add the first non-null label over the layers, and the name of that layer.

    A layer is a column of `df`, or a table of (key, label); of several labels of a key
    in one table the smallest counts. All tables are reduced to the first layer that
    labels a key, so rows are joined once, however many tables there are.
    """
    columns, names = df.columns, [name for name, _ in layers]
    tables = [
        layer.select(
            F.col(key).alias("_of"), F.struct(F.lit(i).alias("layer"), F.col("label").alias("label")).alias("_told")
        ).filter(F.col("_of").isNotNull() & F.col("label").isNotNull())
        for i, (_, layer) in enumerate(layers)
        if isinstance(layer, DataFrame)
    ]
    told = [
        F.when(layer.isNotNull(), F.struct(F.lit(i).alias("layer"), layer.alias("label")))
        for i, (_, layer) in enumerate(layers)
        if isinstance(layer, Column)
    ]
    # columns are evaluated once, before the join
    df = df.withColumn("_own", F.coalesce(*told) if told else F.lit(None).cast("struct<layer:int,label:string>"))
    if tables:
        first = reduce(DataFrame.unionByName, tables).groupBy("_of").agg(F.min("_told").alias("_told"))
        df = skew_join(df, first, [(key, "_of")], "left")
    else:
        df = df.withColumn("_told", F.lit(None).cast("struct<layer:int,label:string>"))
    won = F.least("_own", "_told")  # the smaller layer; null is passed over
    return df.select(
        *columns, won["label"].alias(label), F.get(F.array(*map(F.lit, names)), won["layer"]).alias(source)
    )


@dataclass(frozen=True)
class Step:
    """One step of a cascade: rules of `label` and `kind`, tried with `test`.

    Tests, all without regard to case:
    phrase                 the pattern stands between blanks, or between a blank and an end
    start                  the first word is the pattern, or the text starts with it and a blank
    start_mixed            the same, unless the first word is all capitals
    end_mixed              the last word ends in the pattern, unless it is all capitals
    word_mixed             first or last word, unless all capitals, or a phrase inside the text
    capital_word           a word of two or more capitals
    first_or_last_word, first_word, any_word
    last_word              the last of several words
    """

    label: str
    kind: str
    test: str


_SPAN_TESTS = ("phrase", "start", "start_mixed", "word_mixed")


def _spans(words: Column, last: Column, longest: Column, first: int = 1) -> Column:
    """Runs of up to `longest` words between two positions, blank-joined; null if none."""
    lengths = F.sequence(F.lit(1), F.least(longest, last - first + 1))
    runs = F.transform(
        lengths,
        lambda k: F.transform(
            F.sequence(F.lit(first), last - k + 1),
            lambda i: F.array_join(F.slice(words, i, k), " "),
        ),
    )
    return F.when((last >= first) & (longest > 0), F.flatten(runs))


def _parts(text: Column) -> dict[str, Column]:
    """What the tests look at. Columns of their own, or each word would split the text again."""
    features = token_features(text)
    first, last = features["first_word"], features["last_word"]
    return {
        "_words": F.split(F.lower(text), " "),
        "_size": features["word_count"],
        "_head": F.lower(first),
        "_tail": F.lower(last),
        "_mixed_first": first != F.upper(first),
        "_mixed_last": last != F.upper(last),
        "_capitals": F.split(F.lower(features["capital_words"]), " "),
    }


def _probes(tests: set[str], max_words: Column, max_length: Column) -> Column:
    """Array of (test, probe, hash of both): every string whose equality with a pattern passes the test."""
    words, size, head, tail = (F.col(c) for c in ("_words", "_size", "_head", "_tail"))
    mixed_first, mixed_last = F.col("_mixed_first"), F.col("_mixed_last")
    several = size > 1

    starts = F.concat(
        F.array(head),
        F.coalesce(
            F.when(
                several,
                F.transform(
                    F.sequence(F.lit(1), F.least(max_words, size - 1)),
                    lambda k: F.array_join(F.slice(words, F.lit(1), k), " "),
                ),
            ),
            F.array(),
        ),
    )
    endings = F.transform(
        F.sequence(F.lit(1), F.least(max_length, F.length(tail))),
        lambda k: F.right(tail, k),
    )
    strings = {
        "phrase": lambda: _spans(words, size, F.least(max_words, size - 1)),
        "start": lambda: starts,
        "start_mixed": lambda: F.when(mixed_first, starts),
        "end_mixed": lambda: F.when(mixed_last & (F.length(tail) > 0), endings),
        "word_mixed": lambda: F.concat(
            F.coalesce(F.when(mixed_first, F.array(head)), F.array()),
            F.coalesce(F.when(mixed_last, F.array(tail)), F.array()),
            F.coalesce(_spans(words, size - 1, max_words, first=2), F.array()),
        ),
        "capital_word": lambda: F.col("_capitals"),
        "first_or_last_word": lambda: F.array(head, tail),
        "first_word": lambda: F.array(head),
        "last_word": lambda: F.when(several, F.array(tail)),
        "any_word": lambda: words,
    }

    def marked(test: str) -> Column:
        probes = F.transform(
            F.array_distinct(strings[test]()),
            lambda s: F.struct(F.lit(test).alias("test"), s.alias("probe"), F.xxhash64(F.lit(test), s).alias("hashed")),
        )
        return F.coalesce(probes, F.array())

    return F.flatten(F.array(*[marked(test) for test in sorted(tests)]))


def rule_cascade(
    df: DataFrame,
    text: str,
    rules: DataFrame,
    steps: Sequence[Step],
    default: str,
    name: str = "label",
) -> DataFrame:
    """Add the label of the first step one of whose rules fits the text, else `default`.

    `rules` has the columns label, kind and pattern; patterns are plain strings.
    Every test is turned into equality of strings taken from the text, so all
    steps are one hash join and the smallest step number per distinct text wins.
    A Bloom filter of the patterns, of bounded size, is asked first, where the strings
    are made: those that no rule has are neither shuffled nor joined.
    """
    plan = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"), F.lit(s.label).alias("on_label"),
                F.lit(s.kind).alias("on_kind"), F.lit(s.test).alias("test"),
            )
            for i, s in enumerate(steps)
        ]
    )
    targets = stored(
        rules.select("label", "kind", F.lower("pattern").alias("pattern"), F.inline(plan))
        .filter((F.col("label") == F.col("on_label")) & (F.col("kind") == F.col("on_kind")))
        .groupBy("test", "pattern")
        .agg(F.min(F.struct("step", "label")).alias("won"))
    )
    spans = F.when(F.col("test").isin(*_SPAN_TESTS), F.size(F.split("pattern", " ")))
    max_words = targets.agg(F.coalesce(F.max(spans), F.lit(1)).alias("n")).scalar()
    endings = F.when(F.col("test") == "end_mixed", F.length("pattern"))
    max_length = targets.agg(F.coalesce(F.max(endings), F.lit(1)).alias("n")).scalar()

    tests = {s.test for s in steps}
    probes = (
        df.select(F.col(text).alias("_text")).distinct()
        .withColumns(
            {"_max_words": max_words, "_max_length": max_length, **_parts(F.col("_text"))}
        )
        .select("_text", F.inline(_probes(tests, F.col("_max_words"), F.col("_max_length"))))
        .filter(may_hold(bloom_filter(targets, ["test", "pattern"]), F.col("hashed")))
        .drop("hashed")
    )
    labels = (
        skew_join(
            probes,
            targets.withColumnRenamed("test", "_test"),
            [("test", "_test"), ("probe", "pattern")],
            "inner",
        )
        .groupBy("_text")
        .agg(F.min("won").alias("_won"))
        .select("_text", F.col("_won.label").alias("_label"))
    )
    joined = skew_join(df, labels, [(text, "_text")], "left")
    return joined.withColumn(name, F.coalesce("_label", F.lit(default))).drop("_text", "_label")
