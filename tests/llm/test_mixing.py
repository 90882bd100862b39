from collections import defaultdict

import brute

from tidemark.llm.mixing import emit, mix


def targets(sizes):
    """Shares by weight, the excess over three times a source dealt out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        want = {s: 3 * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and want[s] > 3 * sizes[s]}
        if not over:
            return want
        capped |= over


def check(docs):
    rows = mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(brute.PLAIN.findall(r.text or ""))
        sizes[r.source] += r["size"]
    want, taken, largest = targets(sizes), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s, n in want.items():
        assert abs(taken[s] - n) <= 2 * largest[s]
    return rows


def test_documents(documents):
    rows = check(documents)
    again = {(r.doc_id, r.copies) for r in mix(documents.repartition(7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def test_caps_nulls_and_repeated_rows(frame):
    rows = [(i, "word " * (i % 50 + 1), "big") for i in range(3000)]
    rows += [(i, "word " * 10, s) for i in range(60) for s in ("a", "Z", None, "")]
    rows += [(None, None, "none"), (1, "", "none"), (5, "same words", "twin"), (5, "same words", "twin")]
    found = check(frame(rows, "doc_id long, text string, source string"))
    assert {r.copies for r in found if r.source == "none"} == {0}
    assert {r.copies for r in found if r.source == "Z"} == {3}


def test_emit_and_clashing_names(frame):
    docs = frame([(i, "two words", "s", 9) for i in range(10)], "doc_id long, text string, source string, size long")
    out = emit(mix(docs))
    assert out.count() == sum(r.copies for r in mix(docs).collect()) == 10
    assert set(r["size"] for r in out.collect()) == {2}
    assert mix(docs.limit(0)).count() == 0


def test_extra_columns_of_any_name(frame):
    names = ["rate", "offset", "weight", "cap", "step", "_source", "_place", "key"]
    docs = frame([(i, "two words", "s", *["x"] * len(names)) for i in range(4)],
                 "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    rows = mix(docs).collect()
    assert len(rows) == 4 and all(r[n] == "x" for r in rows for n in names)


def test_carried_columns_and_equal_ids(frame):
    rows = [(1, "s", "a b c"), (1, "s", "d e f"), (1, "s", "g h i"), (2, "t", "x " * 30), (3, None, None), (2, "t", "x " * 30)]
    docs = frame(rows, "doc_id long, source string, text string")
    whole = mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")
    thin = mix(docs, carry=["doc_id"])
    assert "text" not in thin.columns and "source" not in thin.columns
    assert sorted(map(str, thin.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    emitted = [sorted(r.text or "" for r in emit(mix(docs.repartition(n))).collect()) for n in (1, 3, 6)]
    assert emitted[0] == emitted[1] == emitted[2]
    plan = thin._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "text" not in plan
