"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything here is built-in Spark SQL; no user functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, apart, let, whitespace_words

SYMBOLS = "[#*$%&|<>]"
REPEAT = 8  # words of a repeated passage

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on with as at by this be are from or an not "
    "der die das und ist zu den von mit ein eine nicht auf für im dem sich des "
    "le la les et est un une du dans que qui pour pas sur par avec "
    "el los las y en es por con para se no una del lo"
).split()


class Rule(NamedTuple):
    """A ratio of measures that must lie between two bounds (None: no bound)."""

    name: str
    value: str
    per: str
    least: float | None
    most: float | None


# Bounds are wide: clean prose of any of the four languages lies well inside them.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("words_with_letter", "n_letter_words", "n_words", 0.75, None),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letter_words", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines",
)


def repeated_words(words: Column, n: int = REPEAT) -> Column:
    """Words that lie in a window of `n` words found twice or more in `words`.

    Windows are compared by a 64-bit hash. Only where the distinct hashes are fewer
    than the windows are hashes and places sorted, so that equal ones are neighbours;
    then the places of repeated windows are sorted and their lengths added up.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            last = F.size(s) - 1
            return F.transform(
                F.filter(
                    s,
                    lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                    | ((k < last) & (F.get(s, k + 1)["h"] == x["h"])),
                ),
                lambda x: x["i"],
            )

        def length(places: Column) -> Column:
            return F.aggregate(
                F.transform(places, lambda p, k: F.least(F.lit(n), F.coalesce(F.get(places, k + 1) - p, F.lit(n)))),
                F.lit(0),
                lambda total, step: total + step,
            )

        return let(F.array_sort(let(placed, twins)), length)

    hashes = let(
        words,
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n))),
        ),
    )
    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)),
    ).cast("long")


def measures(text: Column) -> Column:
    """A struct of the measures that rules compare, each computed once."""
    whole = F.coalesce(text, F.lit(""))
    stop = [F.lit(w) for w in STOP_WORDS]
    with_words = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def count(found: Column) -> Column:
        return F.size(found).cast("long")

    def matching(values: Column, pattern: str) -> Column:
        return count(F.filter(values, lambda v: v.rlike(pattern)))

    def both(words: Column, lines: Column) -> Column:
        found = {
            "n_words": count(words),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "n_lines": count(lines),
            "n_dup_lines": count(lines) - count(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(words),
            "n_letter_words": matching(words, r"\p{L}"),
            "n_stop_words": count(F.filter(words, lambda w: F.lower(w).isin(*stop))),
            "n_bullet_lines": matching(lines, r"^\s*[-*•]"),
            "n_ellipsis_lines": matching(lines, r"(\.\.\.|…)\s*$"),
        }
        return F.struct(*[c.alias(name) for name, c in found.items()])

    return let(whitespace_words(text), lambda words: let(with_words, lambda lines: both(words, lines)))


def failed(rule: Rule, found: Column) -> Column:
    """Whether measures break the rule. A ratio to zero breaks none."""
    ratio = found[rule.value] / F.when(found[rule.per] > 0, found[rule.per])
    tests = [ratio < rule.least] if rule.least is not None else []
    tests += [ratio > rule.most] if rule.most is not None else []
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    least_words: int = 20,
    most_repeated_percent: int = 30,
) -> DataFrame:
    """Add measures, `base_failed`, `broken` (names of broken rules) and `kept`.

    `base_failed`: fewer than `least_words` words, or more than the given percentage
    of them in repeated passages. A row is kept if it passes that and every rule.
    Null and empty text have no words and fail. One row out for every row in; input
    columns named like an added one are replaced.
    """
    def verdict(found: Column) -> Column:
        base = (found["n_words"] < least_words) | (
            100 * found["n_repeat_words"] > most_repeated_percent * found["n_words"]
        )
        broken = F.array_compact(F.array(*[F.when(failed(r, found), F.lit(r.name)) for r in rules]))
        return let(
            F.struct(base.alias("base_failed"), broken.alias("broken")),
            lambda v: F.struct(
                v["base_failed"].alias("base_failed"),
                v["broken"].alias("broken"),
                (~v["base_failed"] & (F.size(v["broken"]) == 0)).alias("kept"),
            ),
        )

    # One expression each: a filter on `kept`, which Spark moves down to the scan, then
    # computes them once and not once for every rule.
    given, (text,), carried = apart(docs, (*MEASURES, "base_failed", "broken", "kept"), text)
    return (
        given.withColumn("_tm_found", measures(F.col(text)))
        .withColumn("_tm_verdict", let(F.col("_tm_found"), verdict))
        .select(*carried, "_tm_found.*", "_tm_verdict.*")
    )
