import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import fim
from tidemark.llm.fim import Draw, fill_in_middle, fim_documents, restore, restore_documents, rotate


def plainly(text, doc, fim_percent=100, spm_percent=50):
    """n, form, characters of prefix and middle, and output, by slices of a list of lines."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=200), st.data())
def test_rotation_exchanges_blocks(data, draws):
    a, b, c = sorted(draws.draw(st.integers(0, len(data))) for _ in range(3))
    moved = bytearray(data)
    rotate(moved, a, b, c)
    assert bytes(moved) == data[:a] + data[b:c] + data[a:b] + data[c:]
    rotate(moved, a, a + c - b, c)
    assert bytes(moved) == data


def test_rotation_over_several_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    data = bytes(random.Random(1).randbytes(1000))
    for b in (0, 1, 333, 500, 999, 1000):
        moved = bytearray(data)
        rotate(moved, 0, b, 1000)
        assert bytes(moved) == data[b:] + data[:b]


TEXTS = st.text(alphabet="ab\n<PSM>é😀\r\x85 ", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.tuples(*[st.integers(0, 2**32 - 1)] * 4))
def test_every_output_is_restored(text, drawn):
    cut = fill_in_middle(text.encode(), Draw(*drawn))
    assert restore(bytes(cut.data), cut.form) == text.encode()
    assert cut.n == len(re.findall(r"[^\n]*\n|[^\n]+", text))


def test_parts_of_marks_beside_marks():
    for text in ("<\n<S\n>P>", "P>\n<M\n<", "<P\n>\n<S\n>"):
        for form in (0, 99):
            for first in range(4):
                for second in range(4):
                    cut = fill_in_middle(text.encode(), Draw(first, second, 0, form))
                    assert cut.form != "plain" and restore(bytes(cut.data), cut.form) == text.encode()


def test_marks_that_do_not_fit():
    with pytest.raises(ValueError):
        restore(b"no marks", "psm")
    with pytest.raises(ValueError):
        restore(b"<P>a<S>b<M>c", "spm")


def test_rows(frame):
    texts = [None, "", "one", "a\nb\nc", "a <S> b\nc", "\n\n\n", "é\n😀\n", "line\n" * 50_000 + "end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a\nb\nc"), (None, "x\ny\n")]
    docs = frame(rows, "doc_id long, body string").selectExpr(
        "*", "body as _tm_0", "7 as _tm_1", "'z' as n", "'z' as form", "1 as restored"
    )
    out = restore_documents(fim_documents(docs, text="body")).collect()
    for row, (doc, text) in zip(out, rows, strict=True):
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.fim_text) == plainly(text, doc)
        assert row.restored == (text or "") and row["_tm_0"] == text and row["_tm_1"] == 7
    some = fim_documents(docs, text="body", fim_percent=40, spm_percent=100).collect()
    assert [(r.form, r.fim_text) for r in some] == [plainly(t, d, 40, 100)[1::3] for d, t in rows]
    assert fim_documents(docs.limit(0), text="body").count() == 0
    assert restore_documents(frame([(None, "psm"), ("x", None)], "fim_text string, form string")).filter("restored is null").count() == 2
