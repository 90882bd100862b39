import public_tokenizers
import pytest

from pyspark.sql import functions as F

from tidemark.llm.tokens import chars_within, count_tokens, counter, tokens_within

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  hello\n\tworld  ½ ﬁ Ⅳ x　 <s> </s> <0x0A> <unk> 中文字符 😀😀   a", "   ", "\n", "a", "▁▁x", "a" * 40,
    "=====---- ----=====", "é é", "x\x00y", "The quick brown fox", "123456 7890", "don't can't ''''",
]


@pytest.fixture(scope="module")
def tool():
    return counter(MODEL)


def test_counts_equal_the_library(tool, documents):
    texts = [r.text or "" for r in documents.collect()] + ODD
    assert [tool.count(t) for t in texts] == [len(t) for t in tool.library.encode(texts, num_threads=1)]


@pytest.mark.parametrize("text", ODD)
def test_every_prefix(tool, text):
    expected = [len(tool.library.encode(text[:i])) for i in range(1, len(text) + 1)]
    assert tool.all_prefixes(text)[1:] == expected


def test_cut_is_the_longest_that_fits(tool):
    text = ODD[0] * 3
    for limit in range(0, tool.count(text) + 2, 3):
        n = tool.cut(text, limit)
        assert n == 0 or tool.count(text[:n]) <= limit
        assert n == len(text) or tool.count(text[: n + 1]) > limit or limit == 0


def test_a_cut_encodes_nothing_again(tool, monkeypatch):
    text = ODD[0] * 20
    found = tool.prefixes_of(text)
    expected = [tool.cut(text, limit) for limit in range(0, found.total + 2)]

    def never(*_):
        raise AssertionError("encoded again")

    monkeypatch.setattr(tool, "prefixes", never)
    monkeypatch.setattr(tool, "chunks", never)
    assert [min(len(text), found.longest(limit)) for limit in range(0, found.total + 2)] == expected


def test_questions_to_stored_prefixes(frame, tool):
    texts = [*ODD, "", None, "a" * 2000]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    asked = count_tokens(docs, MODEL, prefixes=True, limit=3).select(
        "doc_id", "text", "cut_chars", chars_within(F.col("prefix_tokens"), F.lit(3)).alias("chars"),
        *[tokens_within(F.col("prefix_tokens"), F.lit(c)).alias(f"t{c}") for c in (-1, 0, 2, 7, 5000)],
        tokens_within(F.col("prefix_tokens"), F.lit(None)).alias("none"),
    )
    for r in asked.collect():
        text = r.text or ""
        assert r.chars == r.cut_chars and r.none is None
        assert (r["t-1"], r.t0, r.t5000) == (0, 0, tool.count(text))
        assert (r.t2, r.t7) == (tool.count(text[:2]), tool.count(text[:7]))


def test_cache_that_starts_anew(tool, monkeypatch):
    monkeypatch.setattr("tidemark.llm.tokens.CACHED", 3)
    text = " ".join(f"word{i}" for i in range(50))
    assert tool.count(text) == len(tool.library.encode(text))


def test_rows(frame, tool):
    long = "word and " * 3000 + "x" * 500
    docs = frame([(1, "hé"), (2, None), (3, ""), (4, long), (1, "hé")], "doc_id long, text string")
    rows = count_tokens(docs, MODEL, prefixes=True).collect()
    assert [r.n_bytes for r in rows] == [3, 0, 0, len(long), 3]
    assert [r.n_tokens for r in rows[1:3]] == [0, 0] and rows[0] == rows[4]
    assert rows[3].n_tokens == len(tool.library.encode(long)) and rows[3].over_limit
    assert tool.count(long[: rows[3].cut_chars]) <= 4096
    assert all(r.prefix_tokens[-1] == r.n_tokens for r in rows if r.n_tokens)
    assert count_tokens(docs.limit(0), MODEL).count() == 0
    clash = count_tokens(docs.withColumnRenamed("doc_id", "n_tokens"), MODEL, carry=["n_tokens"])
    assert clash.columns.count("n_tokens") == 1
