import brute

from tidemark.llm.quality import RULES, quality_rules

PROSE = "The house was on the hill and it was not far from the sea that we saw in the morning with all of them."
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_equals_brute_force(documents):
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in quality_rules(documents).collect()}
    expected = {r.doc_id: brute.base_measures(r.text) for r in documents.collect()}
    assert got == expected
    assert any(v[4] for v in expected.values())


def test_repeats_windows_and_lines(frame):
    eight = "a b c d e f g h"
    texts = [
        f"{eight} {eight}", f"x {eight} y {eight} z {eight}", " ".join("ab" * 20), "a " * 9, eight,
        "l1 x\nl1 x\n\n \nl1 x\nl2", " a b \x0b c\x85d", "tab\tand\r\nline\f#$", None, "", " \n\t", PROSE * 50,
    ]
    rows = quality_rules(frame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute.base_measures(texts[r.doc_id]), texts[r.doc_id]


def test_verdicts(frame):
    junk = " ".join(f"{w}###" for w in PROSE.split())
    shout = "\n".join(["same line of the text here"] * 2 + [PROSE])
    table = " | ".join(f"w{i}" for i in range(40))
    rows = quality_rules(
        frame([(1, PROSE), (2, junk), (3, "too short"), (4, shout), (5, table), (6, None)], "doc_id long, text string")
    ).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].kept and by[1].broken == [] and by[4].kept
    assert "symbols_per_word" in by[2].broken and not by[2].kept and not by[2].base_failed
    assert by[3].base_failed and not by[3].kept and not by[6].kept
    assert {"symbols_per_word", "words_with_letter", "stop_words"} & set(by[5].broken)
    assert len({r.name for r in RULES}) == len(RULES)


def test_ties_clashing_names_and_empty_table(frame):
    docs = frame([(1, PROSE, "mine", 7), (1, PROSE, "mine", 7)], "doc_id long, text string, _word string, kept long")
    rows = quality_rules(docs).collect()
    assert rows[0] == rows[1] and rows[0].kept is True and rows[0]._word == "mine"
    assert quality_rules(docs.limit(0)).count() == 0


def test_runs_without_python(documents):
    plan = quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
