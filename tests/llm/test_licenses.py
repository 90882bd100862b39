import math
from collections import Counter

import brute
import pytest

from tidemark.llm.licenses import TEMPLATES, Scorer, ancestors, document_counts, inherit, own_licenses, scan_licenses, vocabulary
from tidemark.llm.queries import op10_licenses

NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
}
PROSE = "The house by the sea was sold to the people of the town in the spring of that year"


def cosine(a, b, idf):
    x, y = ({w: n * idf(w) for w, n in Counter(t).items()} for t in (a, b))
    dot = sum(v * y.get(w, 0) for w, v in x.items())
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_cosine_equals_plain_vectors():
    counts, total = {b"the": 900, b"of": 700, b"license": 20, b"mit": 3}, 1000
    scorer = Scorer(TEMPLATES, counts, total)
    seen = {w.decode(): counts.get(w, 0) for w in vocabulary(TEMPLATES)}
    idf = lambda w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1
    for text in [*NOTICES, PROSE, "Released under the terms of the MIT License, see the file of that name"]:
        words = brute.words(text)
        best = max(
            (round(cosine(words, brute.words(t), idf), 9), name) for name in TEMPLATES for t in TEMPLATES[name]
        )
        got = scorer.best([w.encode() for w in words], 0.2)
        assert (got is None) == (best[0] < 0.2)
        assert got is None or abs(got[0] - best[0]) < 1e-8


@pytest.mark.parametrize("notice, name", NOTICES.items())
def test_notices_at_the_end_of_prose(notice, name):
    scorer = Scorer(TEMPLATES, {b"the": 900, b"of": 700}, 1000)
    found = scorer.scan(f"{PROSE}.\n{PROSE}\n{notice}".encode(), 0.6)
    assert found[0] == name and not found[2]
    assert scorer.scan(notice.encode(), 0.6)[2]
    assert scorer.scan(PROSE.encode(), 0.6) == (None, None, False)


def test_wrapped_headers():
    long = TEMPLATES["Apache-2.0"][2].split()
    lines = "\n".join("# " + " ".join(long[i : i + 6]) for i in range(0, len(long), 6))
    assert Scorer(TEMPLATES, {}, 10).scan(f"code\n\n{lines}\n\nmore code".encode(), 0.6)[0] == "Apache-2.0"


def test_counts_over_all_rows(frame):
    docs = frame([(1, "mit license mit"), (2, "MIT"), (3, None), (4, ""), (5, "other")], "doc_id long, text string")
    counts, total = document_counts(docs, "text", [b"mit", b"license", b"gpl"])
    assert (counts, total) == ({b"mit": 2, b"license": 1}, 3)


def test_nearest_directory_above(frame):
    mit, gpl = "Released under the MIT License", "This work is licensed under the GNU General Public License, version 3"
    rows = [
        ("a/LICENSE", mit), ("a/b/c/COPYING", gpl + "\n" + PROSE), ("a/x.txt", PROSE), ("a/b/y.txt", PROSE),
        ("a/b/c/z.txt", PROSE), ("a/b/c/d/e.txt", PROSE), ("/a//b/q.txt", None), ("top.txt", PROSE),
        ("a/b/own.txt", PROSE + "\n" + gpl), (None, PROSE), ("ab/n.txt", PROSE), ("a/x.txt", PROSE),
    ]
    files = frame([(i, p, t) for i, (p, t) in enumerate(rows)], "id long, path string, text string")
    got = {r.id: (r.license, r.inherited_from) for r in inherit(own_licenses(files)).collect()}
    assert got[2] == got[11] == ("MIT", "a") and got[3] == ("MIT", "a") and got[6] == ("MIT", "a")
    assert got[4] == ("GPL-3.0", "a/b/c") and got[5] == ("GPL-3.0", "a/b/c") and got[8] == ("GPL-3.0", None)
    assert got[7] == got[9] == got[10] == (None, None) and got[0] == ("MIT", None) and len(got) == len(rows)


def test_root_ties_and_clashing_names(frame):
    mit, isc = "Released under the MIT License", "Released under the ISC License"
    rows = [("LICENSE", mit), ("LICENSE.isc", isc), ("x/y", PROSE)]
    files = frame([(p, t, "old") for p, t in rows], "path string, text string, license string")
    got = {r.path: (r.license, r.inherited_from) for r in inherit(own_licenses(files)).collect()}
    assert got["x/y"] == ("ISC", "") and got["LICENSE"][0] == "MIT"
    assert inherit(own_licenses(files.limit(0))).count() == 0
    assert scan_licenses(files.limit(0)).count() == 0
    scanned = {r.path: r.license for r in scan_licenses(files).collect()}
    assert scanned == {p: v[0] for p, v in got.items()}
    depth = files.select(ancestors(files["path"]).alias("a")).collect()
    assert [(x.above, x.depth) for x in depth[2].a] == [("", 0), ("x", 1), ("x/y", 2)]


def test_query(spark, small, documents):
    got = {r.doc_id: r for r in op10_licenses(spark, small).collect()}
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert set(got) == set(texts)
    for doc, text in texts.items():
        said = {name for notice, name in NOTICES.items() if notice.rstrip(".") in text}
        assert not said or got[doc].own_license in said
        if not any(w in text.lower() for w in ("licen", "copyright", "permission", "public")):
            assert got[doc].own_license is None
