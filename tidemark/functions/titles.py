"""Titles before and honours after a personal name."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip_space

# Words known as the first, second or third word of a title, in
# lower case and without dots.
FIRST_WORDS = (
    "ms", "mr", "dr", "mdm", "miss", "mrs",
    "adj", "prof", "adjunct", "asst", "a/prof", "assoc", "professor", "a/p",
    "insp", "asp", "dsp", "supt(1a)", "supt(1)", "supt", "dac", "ac", "sac", "dc", "cp", "comr",
    "mwo", "swo", "cwo", "cpt", "capt", "maj", "ltc", "sltc", "col", "col(dr)", "bg", "mg",
    "me5", "me6", "me7", "me8", "me9", "radm",
    "pdj", "dj", "ci", "ar", "ag",
)
SECOND_WORDS = (
    "a/p", "prof", "a/prof", "associate", "asst", "(ret)", "(v)", "(dr)", "(ns)", "(1a)", "1a",
)
THIRD_WORDS = ("(mr)", "(ms)", "(mrs)", "(mdm)", "prof", "(dr)")

# Honours that start the trailing part of a name.
HONOURS = (
    "DUNU", "DUBC", "PGP", "PJG", "BBM", "PPA(E)", "PPA (E)", "PPA(P)", "PPA (P)", "PPA(G)",
    "PPA (G)", "PK", "PBM", "P Kepujian", "P. Kepujian", "PB", "PBS", "CRM",
)

# Patterns of the titles dropped before a name is split into words.
# The first that matches wins, so the order counts.
TITLE_PATTERNS = (
    r"Adj\.? A/Prof\.?", r"Clin A/Prof\.?", r"A/Prof\.?",
    r"Mr\.", r"Mrs\.", r"Ms\.", r"Miss", r"Mdm\.", r"Dr\.", r"Prof\.", r"Er\.", r"Ar\.",
    r"Assoc Prof\.?", r"Adj Assoc Prof\.?", r"Clin Assoc Prof\.?", r"Asst Prof\.?",
    r"Sr Asst Prof\.?", r"Adj Asst Prof\.?", r"Visiting Prof\.?", r"Emeritus Prof\.?",
    r"Professor\.?", r"Associate Professor\.?", r"Assistant Professor\.?",
    r"AC", r"DAC", r"SAC", r"SUPT", r"DSP", r"ASP", r"INSP", r"LTC", r"MAJ", r"CPT", r"LTA",
    r"COL", r"SLTC", r"BG", r"MG", r"LG", r"RADM", r"ME",
    r"SLTC\(NS\)", r"COL\(NS\)", r"LTC\(NS\)", r"MAJ\(NS\)",
    r"Senior Minister", r"Minister", r"Justice", r"Judge", r"Hon\.", r"The Hon\.", r"Sen\.",
    r"Mr", r"Mrs", r"Ms", r"Mdm", r"Dr", r"Prof", r"Er", r"Ar", r"Hon", r"Sen",
    r"Sir", r"Dame", r"Lady", r"Lord",
)


_SPACE, _NO_SPACE = r"\p{IsWhite_Space}", r"\P{IsWhite_Space}"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _dotted(words: Sequence[str]) -> str:
    """Regular expression of one whole word out of the list, dots anywhere in it."""
    choice = "|".join(r"\.*+".join(re.escape(letter) for letter in word) for word in words)
    return rf"\.*+(?:{choice})\.*+(?!{_NO_SPACE})"


def leading_title(
    col: Column | str,
    first: Sequence[str] = FIRST_WORDS,
    second: Sequence[str] = SECOND_WORDS,
    third: Sequence[str] = THIRD_WORDS,
    exclude: Sequence[str] = (),
) -> Column:
    """The longest leading title of one to three words, null if there is none.

    A known second word makes the first two words the title whatever the first
    is, and a known third word the first three, unless the whole value is listed
    in `exclude`. Dots at the end of the title are dropped.
    """
    value = _col(col)
    word = rf"{_NO_SPACE}++{_SPACE}++"
    shorter = [word + _dotted(second), _dotted(first)]
    longer = [word + word + _dotted(third), *shorter]

    def found(alternatives: list[str]) -> Column:
        regex = rf"(?i)^{_SPACE}*+({'|'.join(alternatives)})"
        return F.regexp_extract(value, regex, 1)

    title = found(longer)
    if exclude:
        title = F.when(value.isin(*exclude), found(shorter)).otherwise(title)
    single_spaced = F.regexp_replace(F.nullif(title, F.lit("")), f"{_SPACE}+", " ")
    return F.rtrim(single_spaced, F.lit("."))


def trailing_suffix(
    col: Column | str, tokens: Sequence[str] = HONOURS, whole_word: bool = False
) -> Column:
    """From the earliest of the tokens to the end, null if none occurs.

    A token also counts inside a word unless `whole_word` is set.
    """
    choice = "|".join(re.escape(token) for token in tokens)
    initials = "".join(sorted({re.escape(token[0]) for token in tokens}))
    edge_before, edge_after = (r"(?<!\w)", r"(?!\w)") if whole_word else ("", "")
    found = F.regexp_extract(_col(col), f"(?s){edge_before}(?=[{initials}])(?:{choice}){edge_after}.*", 0)
    return F.nullif(found, F.lit(""))


def strip_affixes(name: Column | str, prefix: Column | str, suffix: Column | str) -> Column:
    """Cut the title with one separator, cut the suffix, trim, drop end commas.

    The cut goes by the length of the title as returned by `leading_title`, so
    irregular spacing inside a title can leave or take a character.
    """
    name, prefix, suffix = _col(name), _col(prefix), _col(suffix)

    def cut_length(affix: Column, extra: int) -> Column:
        return F.when(affix.rlike(_NO_SPACE), F.length(affix) + extra).otherwise(0)

    rest = F.substr(name, cut_length(prefix, 1) + 1)
    kept = F.greatest(F.length(rest) - cut_length(suffix, 0), F.lit(0))
    return F.rtrim(strip_space(F.left(rest, kept)), F.lit(","))


def strip_leading_titles(
    col: Column | str, patterns: Sequence[str] = TITLE_PATTERNS
) -> Column:
    """Drop one leading title, whatever its case."""
    return F.trim(F.regexp_replace(_col(col), rf"^(?i)({'|'.join(patterns)})\s+", ""))
