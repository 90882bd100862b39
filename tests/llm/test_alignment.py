import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.alignment import align_tokens, pack, unpack
from tidemark.llm.fragments import (
    B_BITS, EMPTY, WHITE, Fragment, Tokens, TwoTokenizers, Writer, byte_alphabet, byte_ranges, compose, compose_all,
    groups_of, linked, read_groups,
)
from tidemark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "a", " ", "  two  spaces ", "x;\r\ny\r z", "a!\x85\xa0\n\nb", "　   x", "tab\tand\x0b\x0c\x1c\x1f end ",
    "<|endoftext|> <s> </s> <0x0A> <unk>", "中文字符 😀😀 é é ½ ﬁ", "'s don't WE'LL 123456 7890", "=====-----=====" * 5,
    "q" * 300, "mark ▁ in text", "\x00 nul", "\n\n\n", "a\n", " a᠎b​﻿", "\r\r\n x",
]


@pytest.fixture(scope="module")
def both():
    return TwoTokenizers(A, B)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_groups(both, library, text):
    """Groups by encoding the whole text with the libraries of the files."""
    if not text:
        return None
    rows = []
    for ids, spelt in (
        (library.encode(" " + text, add_special_tokens=False).ids, both.a_bytes),
        (both.b.encode(text, num_threads=1), both.b_bytes),
    ):
        if b"".join(spelt[i] for i in ids) != (" " + text).encode():
            return None
        end, row = 0, []
        for i in ids:
            end += len(spelt[i])
            row.append((i, end))
        rows.append(row)
    common = {e for _, e in rows[0]} & {e for _, e in rows[1]}
    out = [([], []) for _ in common]
    for side, row in enumerate(rows):
        at = 0
        for i, e in row:
            out[at][side].append(i)
            at += e in common
    return out


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain_result(both, library, texts):
    found = [plain_groups(both, library, t or "") for t in texts]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in found]
    count = Counter(p for held in links for p in held)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return [
        (
            sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), held.total(),
            sum(m for p, m in held.items() if count[p] == best[p[0]]), sum(m * count[p] for p, m in held.items()),
            hashlib.sha256(written(g).encode()).hexdigest() if g else "",
        )
        for g, held in zip(found, links, strict=True)
    ]


def test_whole_texts(both, library, documents):
    for text in [r.text or "" for r in documents.collect()] + ODD:
        expected = plain_groups(both, library, text)
        found = both.text(text)
        assert (found is None) == (expected is None), repr(text)
        if found:
            assert found[0].decode() == written(expected), repr(text)


def test_every_character(both, library):
    """The quicker library and the file's own agree, whatever a character is next to."""
    every = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200))]
    for i in range(0, len(every), 4096):
        text = "".join(f"a{c}1{c}!{c} {c}{c}\n" for c in every[i : i + 4096])
        assert both.encode_a(text) == library.encode(text, add_special_tokens=False).ids
    assert all(c.isspace() for c in WHITE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab;!'s1 \t\n\r\x0b\x85\xa0 　é中▁<>", max_size=40))
def test_any_text(both, library, text):
    expected, found = plain_groups(both, library, text), both.text(text)
    assert (found and found[0].decode()) == (expected and written(expected))


def counted(both, monkeypatch):
    calls, encode = [], both.encode_a
    monkeypatch.setattr(both, "encode_a", lambda text: calls.append(text) or encode(text))
    return calls


def test_new_words_of_many_texts_are_encoded_together(both, library, monkeypatch):
    """Few calls for many short texts, and the same groups, whatever white space they end in."""
    texts = [f"{w}{i}x{end}" for i, w in enumerate(["one two", "\u3000 six", "bad ▁ ", "two"] * 40) for end in ("", " ", "\n \t")] + ODD
    calls = counted(both, monkeypatch)
    both.forget()
    found = list(both.texts(texts))
    assert len(calls) < len(texts)
    for text, got in zip(texts, found, strict=True):
        expected = plain_groups(both, library, text)
        assert (got and got[0].decode()) == (expected and written(expected)), repr(text)
        if got:
            codes, times = linked(read_groups(written(expected)))[4:]
            assert tuple(got[1][:4]) == linked(read_groups(written(expected)))[:4]
            assert got[1].codes.tolist() == codes.tolist() and got[1].times.tolist() == times.tolist()


def test_one_word_without_tokens_among_many(both, monkeypatch):
    calls = counted(both, monkeypatch)
    words = [f"apart{i}" for i in range(400)]
    assert both.text(" ".join([*words[:200], "mark▁inside", *words[200:]])) is None
    assert len(calls) < 60
    before = len(calls)
    assert both.text(" ".join(words)) and len(calls) == before


def test_words_are_forgotten(both, library, monkeypatch):
    """Those met most often stay, within both bounds; groups and links stay right."""
    monkeypatch.setattr("tidemark.llm.fragments.CACHED", 50)
    both.forget()
    texts = [f"often again n{i} m{i} " + "q" * (60 + i) for i in range(120)]
    for i in range(0, 120, 10):
        found = [f[0].decode() for f in both.texts(texts[i : i + 10])]
        assert found == [written(plain_groups(both, library, t)) for t in texts[i : i + 10]]
        assert len(both.known) <= 100 + 32 and {" often", " again"} <= both.known.keys()
    small = both.known.kept(50, 200, 48)
    assert 0 < small.bytes <= 200 and len(small) == len(small.groups) == small.first.n == small.met.n
    assert all(small.groups[n] == both.known.groups[both.known[w]] for w, n in small.items())
    assert len(both.known.kept(10**6, 10**9, 48)) == sum(len(w) <= 48 for w in both.known)
    both.forget()


ENDS = st.lists(st.integers(1, 40), unique=True, max_size=25).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS, st.lists(st.integers(0, 41), max_size=6), st.randoms())
def test_fragments_compose_in_any_order(a, b, cuts, rng):
    write = Writer(10).fragment
    a, b = (Tokens(np.array([rng.randint(0, 5) for _ in e] + [9]), np.array([*e, 41])) for e in (a, b))
    whole = write(a, b)
    cuts = [0, *sorted(cuts), 41]
    row = [write(a.within(x, y), b.within(x, y)) for x, y in zip(cuts, cuts[1:], strict=False)]
    assert compose_all(row) == whole
    assert all(compose(EMPTY, f) == f == compose(f, EMPTY) for f in row)
    while len(row) > 1:
        i = rng.randrange(len(row) - 1)
        row[i : i + 2] = [compose(row[i], row[i + 1])]
    assert row[0] == whole
    assert groups_of(whole).count(";") + 1 == len(set(a.ends) & set(b.ends))


def test_open_parts():
    def write(a, b):
        return Writer(10).fragment(*(Tokens(np.array([i for i, _ in t]), np.array([e for _, e in t])) for t in (a, b)))

    left, right = write([(1, 2)], [(7, 1)]), write([(2, 6)], [(8, 4), (9, 6)])
    assert left == Fragment("1|7", None, "") and compose(left, right) == Fragment("1,2|7,8,9", "", "|")
    with pytest.raises(ValueError):
        groups_of(left)


@pytest.mark.parametrize("size", [1, 3, 7, 40, 1000])
def test_ranges_inside_words(both, library, size):
    for text in ODD + [" ".join(ODD), "wordy unbelievably antidisestablishmentarianism. " * 9]:
        whole = plain_groups(both, library, text)
        if whole is None:
            continue
        words = list(both.words_of(text))
        assert "".join(words) == " " + text
        parts = [both.range_of(*part) for part in byte_ranges(words, size)]
        assert groups_of(compose_all(parts)) == written(whole)


@pytest.mark.parametrize("wide", [1, 5, 1 << 12])
def test_links_of_groups(wide, monkeypatch):
    monkeypatch.setattr("tidemark.llm.fragments.WIDE", wide)
    found = linked(read_groups("1,2,1|5,5;3|6;1|5"))
    assert found[:4] == (5, 4, 3, 8)
    pairs = dict(zip(found.codes.tolist(), found.times.tolist(), strict=True))
    assert pairs == {1 << B_BITS | 5: 5, 2 << B_BITS | 5: 2, 3 << B_BITS | 6: 1}
    codes, times = unpack(pack(found.codes, found.times))
    assert codes.tolist() == sorted(pairs) and times.tolist() == [5, 2, 1]
    assert linked(read_groups(""))[:4] == (0, 0, 0, 0)
    assert len(byte_alphabet()) == 256


def test_rows(frame, both, library):
    rng = random.Random(5)
    words = [w for t in ODD for w in t.split(" ")] + ["the", "cat", "sat", "Unbelievable"]
    texts = [*ODD, None, "the cat"] + [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(80)]
    texts += ["the cat", "long text, " * 4000 + "x" * 900, "bad ▁ " + "y " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = frame(rows, "id long, text string").selectExpr("*", "1 as n_a", "id as _tm_row", "2 as row", "3 as body").repartition(3)
    found = align_tokens(docs, A, B, range_bytes=500, batch_bytes=4000).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    by_id = {r.id: r for r in found}
    assert len(found) == len(texts) and all(r["_tm_row"] == r.id and r["row"] == 2 for r in found)
    for i, expected in enumerate(plain_result(both, library, texts)):
        assert tuple(by_id[i][c] for c in names) == expected, repr(texts[i])
    assert align_tokens(docs.limit(0), A, B).count() == 0
    assert [r.n_a for r in align_tokens(frame([(None,), ("",)], "text string"), A, B).collect()] == [0, 0]


def test_query(spark, small, documents, both, library):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    expected = {d: v for (d, _), v in zip(rows, plain_result(both, library, [t for _, t in rows]), strict=True)}
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, small).collect()}
    assert found == expected
