"""Titles, suffixes and cleaned names: worked by hand, and what must hold for any name."""

import random

import pytest

from tidemark.functions.titles import FIRST_WORDS, HONOURS, SECOND_WORDS, THIRD_WORDS
from tidemark.operators.names import split_names

BY_HAND = [
    # name, title, suffix, rest
    ("Dr John Tan", "Dr", None, "John Tan"),
    ("Dr. John Tan", "Dr", None, ". John Tan"[2:]),
    ("MRS Mariam", "MRS", None, "Mariam"),
    ("John Dr Tan", None, None, "John Dr Tan"),
    ("John", None, None, "John"),
    ("", None, None, ""),
]


@pytest.fixture(scope="module")
def split(spark):
    def run(names):
        df = spark.createDataFrame([(n,) for n in names], "name string")
        return {r.name: (r.prefix, r.postfix, r.extracted_name) for r in split_names(df).collect()}

    return run


def test_by_hand(split):
    got = split([n for n, *_ in BY_HAND])
    for name, title, suffix, _ in BY_HAND:
        assert got[name][:2] == (title, suffix), name
    assert got["Dr John Tan"][2] == "John Tan" and got["MRS Mariam"][2] == "Mariam"
    assert got["John Dr Tan"][2] == "John Dr Tan" and got[""][2] == ""


def test_each_listed_word_is_a_title_in_its_place(split):
    names = {f"{w} Zz Zz": 1 for w in FIRST_WORDS}
    names |= {f"zz {w} Zz": 2 for w in SECOND_WORDS}
    names |= {f"zz zz {w} Zz": 3 for w in THIRD_WORDS}
    got = split(list(names))
    for name, size in names.items():
        title = got[name][0]
        assert title is not None and len(title.split()) >= size and name.startswith(title), name
        assert got[name][1] is None or any(h in name for h in HONOURS)


def test_each_honour_starts_the_suffix(split):
    names = {f"Zz Yy {h}": h for h in HONOURS}
    got = split(list(names))
    for name in names:
        _, suffix, rest = got[name]
        assert suffix and name.endswith(suffix) and any(suffix.startswith(h) for h in HONOURS), name
        assert not rest.endswith((" ", ",")) and name.startswith(rest)


def test_parts_of_random_names_join_back(split):
    """Of singly spaced names without dots: title, rest and suffix make up the name."""
    rng = random.Random(20)
    plain = [w for w in (*FIRST_WORDS, *SECOND_WORDS, *THIRD_WORDS) if w.isalpha()]
    pool = [*plain, "John", "TAN", "Mariam", "x"]
    names = set()
    for _ in range(3_000):
        words = [w.upper() if rng.random() < 0.3 else w for w in rng.choices(pool, k=rng.randrange(1, 6))]
        if rng.random() < 0.3:
            words.append(rng.choice(HONOURS))
        names.add(" ".join(words))
    for name, (title, suffix, rest) in split(sorted(names)).items():
        left = name[len(title):] if title else name
        if suffix:
            assert left.endswith(suffix) or not left, name
            left = left[: len(left) - len(suffix)]
        assert left.strip().rstrip(",").strip() == rest.strip(), (name, title, suffix, rest)
        words = name.split()
        if title:
            assert words[: len(title.split())] == title.split() and len(title.split()) <= 3
        else:
            assert words[0].lower() not in FIRST_WORDS
