"""Words of a text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_space(col: Column | str) -> Column:
    """Trim any Unicode white space, not only blanks."""
    return F.regexp_replace(_col(col), r"(?U)^\s+|\s+$", "")


def collapse_space(col: Column | str) -> Column:
    """Trim, and write every run of white space as one blank."""
    return F.trim(F.regexp_replace(_col(col), r"(?U)\s+", " "))


def token_features(col: Column | str) -> dict[str, Column]:
    """Named features of the blank-separated words of a text.

    `capital_words` holds the words of two or more letters that are all A-Z.
    """
    words = F.split(_col(col), " ")
    capitals = F.filter(words, lambda word: word.rlike("^[A-Z]{2,}$"))
    return {
        "first_word": F.get(words, 0),
        "last_word": F.element_at(words, -1),
        "all_words": words,
        "word_count": F.size(words),
        "capital_words": F.nullif(F.array_join(capitals, " "), F.lit("")),
    }


def shares_word(old: Column | str, new: Column | str) -> Column:
    """Whether a word of `old` occurs in `new`, whatever the case.

    Words of two or more letters count whole; of five or more, the first four
    letters are enough.
    """
    target = F.upper(_col(new))

    def found(word: Column) -> Column:
        size = F.length(word)
        whole = (size >= 2) & F.contains(target, word)
        start = (size >= 5) & F.contains(target, F.left(word, F.lit(4)))
        return whole | start

    return F.coalesce(F.exists(F.split(F.upper(_col(old)), " "), found), F.lit(False))


def _like_regex(pattern: str) -> str:
    """A LIKE pattern as a regular expression to be found anywhere in the value."""
    start, end = pattern.startswith("%"), pattern.endswith("%")
    body = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern.strip("%"))
    return f"{'' if start else '^'}{body}{'' if end else chr(92) + 'z'}"


def matches_any(col: Column | str, patterns: Sequence[str]) -> Column:
    """Whether the lower-cased value is LIKE one of the patterns.

    One regular expression, so that the value is worked out only once.
    """
    if not patterns:
        return F.lit(False)
    regex = "(?s)" + "|".join(_like_regex(p) for p in patterns)
    return F.regexp_like(F.lower(_col(col)), F.lit(regex))
