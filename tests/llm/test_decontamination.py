import brute
import pytest

from tidemark.llm.decontamination import Matcher, decontaminate, merged, spans_of, words_of

ITEM = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, ITEM), (2, "Short item"), (3, None), (4, "..."), (10, ITEM)]


def result(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_equals_brute_force(spark, small, documents):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    got = result(decontaminate(documents, items))
    expected = brute.decontaminated(
        [(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    assert any(v[4] for v in expected.values())
    for doc, (n_words, n_hit, n_items, _, contaminated) in expected.items():
        r = got[doc]
        assert (r.n_words, r.n_hit, len(r["items"]), r.contaminated) == (n_words, n_hit, n_items, contaminated)


@pytest.mark.parametrize("part_bytes", [10, 40, 10_000])
def test_windows_items_and_spans(frame, part_bytes):
    text = "Zero ONE two,three four\nfive six seven eight nine ten; eleven twelve é short ITEM"
    docs = frame(
        [(1, text), (2, None), (3, ""), (4, "one two three four five six seven eight nine"), (None, "short-item"), (1, text)],
        "doc_id long, text string",
    )
    rows = decontaminate(docs, frame(ITEMS, "item_id long, text string"), part_bytes=part_bytes).collect()
    first = rows[0]
    assert (first.n_words, first.n_hit, first["items"]) == (16, 14, ["1", "10", "2"])
    assert "|".join(text[s.start : s.end] for s in first.spans) == (
        "ONE two,three four\nfive six seven eight nine ten; eleven twelve|short ITEM"
    )
    assert rows[5] == first
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows[1:4]] == [
        (0, 0, [], False), (0, 0, [], False), (9, 0, [], False)
    ]
    assert rows[4].n_hit == 2 and rows[4].doc_id is None


def test_overlapping_windows_of_several_parts_count_words_once(frame):
    a = "a b c d e f g h i j"
    b = "f g h i j k l m n o"
    docs = frame([(1, "a b c d e f g h i j k l m n o p")], "doc_id long, text string")
    items = frame([(i, t) for i, t in enumerate([a, b, a, b])], "item_id long, text string")
    for part_bytes in (5, 1000):
        (row,) = decontaminate(docs, items, part_bytes=part_bytes).collect()
        assert (row.n_hit, row["items"]) == (15, ["0", "1", "2", "3"])


def test_names_that_clash_and_empty_tables(frame):
    docs = frame([(1, "short item", 5, "x")], "doc_id long, text string, n_hit long, word string")
    items = frame(ITEMS, "item_id long, text string")
    (row,) = decontaminate(docs, items).collect()
    assert (row.n_hit, row.word) == (2, "x")
    assert decontaminate(docs.limit(0), items).count() == 0
    (row,) = decontaminate(docs, items.limit(0)).collect()
    assert (row.n_hit, row.contaminated) == (0, False)


def test_very_long_text_and_many_words():
    raw = (" ".join(f"w{i}" for i in range(200_000)) + " " + ITEM).encode()
    matcher = Matcher([("1", ITEM.encode()), ("2", " ".join(f"v{i}" for i in range(70_000)).encode())], 10)
    ranges, items = matcher.find(words_of(raw))
    assert ranges == [(200_000, 200_012)] and items == {"1"}
    (span,) = spans_of(raw, ranges)
    assert raw.decode()[span["start"] : span["end"]] == ITEM
    assert merged([(3, 5), (1, 2), (2, 4)]) == [(1, 5)]
