"""Input columns named like added or inner ones, in every operator that adds columns."""

import public_tokenizers
import pytest

from tidemark.llm.decontamination import decontaminate
from tidemark.llm.licenses import inherit, own_licenses
from tidemark.llm.mixing import mix
from tidemark.llm.quality import quality_rules
from tidemark.llm.sharding import assign_shards
from tidemark.llm.tokens import count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(1, "a few words of text", "s"), (2, None, None), (3, "", "s"), (1, "a few words of text", "s")]


def benchmark(docs):
    return docs.sparkSession.createDataFrame([(1, "few words of")], "item_id long, text string")


OPERATORS = {
    "decontaminate": (lambda d, t: decontaminate(d, benchmark(d), text=t), ["items", "n_hit", "_raw", "_tm_raw"]),
    "quality_rules": (lambda d, t: quality_rules(d, text=t), ["kept", "n_words", "_raw"]),
    "count_tokens": (lambda d, t: count_tokens(d, MODEL, text=t), ["_text", "_tm_text", "n_tokens"]),
    "assign_shards": (lambda d, t: assign_shards(d, text=t), ["size", "shard", "slot"]),
    "mix": (lambda d, t: mix(d, text=t), ["size", "taken", "_tm_given"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_text_under_any_name(frame, name):
    run, names = OPERATORS[name]
    plain = run(frame(ROWS, "doc_id long, text string, source string"), "text")
    added = [c for c in plain.columns if c not in ("doc_id", "text", "source")]
    expected = sorted(map(str, plain.select("doc_id", *added).collect()))
    for other in names:
        docs = frame(ROWS, f"doc_id long, {other} string, source string")
        got = run(docs, other)
        assert len(set(got.columns)) == len(got.columns)
        assert sorted(map(str, got.select("doc_id", *added).collect())) == expected
        extra = frame([(*r, "x") for r in ROWS], f"doc_id long, text string, source string, {other} string")
        got = run(extra, "text")
        assert len(set(got.columns)) == len(got.columns)
        assert sorted(map(str, got.select("doc_id", *added).collect())) == expected


def test_licences_with_inner_names(frame):
    files = frame([("a/LICENSE", "no licence here", 1), (None, None, 2)], "path string, text string, _tm_raw int")
    scanned = own_licenses(files)
    assert sorted(r._tm_raw for r in inherit(scanned).collect()) == [1, 2]
