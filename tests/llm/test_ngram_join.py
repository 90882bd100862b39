import random
import tracemalloc

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram_join
from tidemark.llm.components import components
from tidemark.llm.common import Scratch
from tidemark.llm.ngram_join import Hasher, bands_and_rows, near_duplicates, one_of_each, words_of


def classes_of(rows):
    """Brute force over all pairs: {place: class}, and the linked pairs."""
    sets = [brute.shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links.add((j, i))
                up[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], links


def partition(labels):
    out = {}
    for i, label in enumerate(labels):
        out.setdefault(label, set()).add(i)
    return sorted(map(sorted, out.values()))


def found(df, rows, **options):
    got = {r.doc_id: r for r in near_duplicates(df, **options).collect()}
    return [got[i] for i, _ in rows]


def edited(rng, words, share):
    return " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(rng.random()) if rng.random() < share else w for w in words)


def test_bands_reach_the_recall():
    bands, rows = bands_and_rows(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 128
    assert bands_and_rows(0.5, 0.99, 256)[1] < bands_and_rows(0.9, 0.99, 256)[1]


def test_hashes_depend_on_the_sequence_only():
    hasher = Hasher(5, 4, 2)
    words = words_of(b"The quick, brown fox jumps over the lazy dog and runs away")
    again = words_of(b"the QUICK brown--fox jumps over the lazy dog and runs away!")
    assert (hasher.band_hashes(words) == hasher.band_hashes(again)).all()
    grams = hasher.grams(words * 3)
    assert len(grams) == 32 and len(np.unique(grams)) == 12
    assert len(hasher.grams([b"one", b"two"])) == 1
    assert hasher.grams([b"ab", b"c"]) != hasher.grams([b"a", b"bc"])


def test_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    labels, links = classes_of(rows)
    got = found(documents, rows)
    assert partition([r.class_id for r in got]) == partition(labels) and links
    for members in partition(labels):
        ids = [rows[i][0] for i in members]
        assert {got[i].class_id for i in members} == {min(ids)}
        assert [rows[i][0] for i in members if got[i].kept] == [min(ids)]
    assert {r.doc_id for r in one_of_each(documents, near_duplicates(documents)).collect()} == {
        r.doc_id for r in got if r.kept
    }


@pytest.mark.parametrize("block", [4, 512])
@pytest.mark.parametrize("seed, share", [(1, 0.01), (2, 0.02), (3, 0.035)])
def test_groups_whose_leader_is_not_like_all(frame, seed, share, block):
    """Copies with so many edits that only some pairs are similar: classes all the same."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    texts = [edited(rng, base, share * rng.choice([0.3, 1, 2])) for _ in range(60)]
    texts += [" ".join(base)] * 5 + [" ".join(rng.choices(base, k=80)) for _ in range(10)]
    rows = list(enumerate(texts))
    labels, _ = classes_of(rows)
    got = found(frame(rows, "doc_id long, text string").repartition(3), rows, block=block)
    assert partition([r.class_id for r in got]) == partition(labels)


@pytest.mark.parametrize("block", [2, 4, 512])
def test_every_link_of_a_text_counts(frame, block):
    """Not only those that join its class: brute force over all pairs of different texts."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    texts = [edited(rng, base, share) for share in (0.003, 0.01, 0.02, 0.03) for _ in range(10)]
    alike = ["alpha beta gamma delta epsilon zeta", "Alpha, beta gamma delta epsilon zeta!", "ALPHA beta; gamma delta epsilon zeta"]
    rows = list(enumerate([*dict.fromkeys([*texts, " ".join(base), *alike]), texts[0], alike[0]]))
    _, links = classes_of(rows)
    different = {t: i for i, t in reversed(rows)}
    want = {t: sum(i in link for link in links if set(link) <= set(different.values())) for t, i in different.items()}
    got = found(frame(rows, "doc_id long, text string").repartition(3), rows, block=block)
    assert [r.n_links for r in got] == [want[t] for _, t in rows]
    assert got[rows[-1][0]].n_links == 2 and max(want.values()) > 10


def block_rows(texts, second=0, **more):
    rows = []
    for k, text in enumerate(texts):
        raw = text.encode()
        weight = ngram_join.GRAM_BYTES * max(1, len(words_of(raw)) - 4) + 5 * len(raw)
        rows.append({"key": bytes([k]), "raw": raw, "weight": weight, "times": k % 3 + 1, "i": 0, "j": second and 1,
                     "block": int(k < second), "component": bytes([k]), "band": 7, "bands": [7], **more})
    return rows


@pytest.mark.parametrize("second", [0, 11])
def test_runs_of_a_block_find_the_same(monkeypatch, second):
    """Blocks held in parts give the counts and classes of blocks held whole."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    rows = block_rows([edited(rng, base, rng.choice([0.003, 0.02])) for _ in range(30)], second)
    whole = sorted(ngram_join._counts_of_block(rows, 5, 0.8))

    def joined():
        up = {r["key"]: r["key"] for r in rows}
        for a, b in ngram_join._links_of_block(rows, 5, 0.8):
            old, new = up[a], up[b]
            up = {k: new if v == old else v for k, v in up.items()}
        return partition(list(up.values()))

    classes = joined()
    assert len(whole) > 10
    for most in (1, rows[0]["weight"] * 3):
        monkeypatch.setattr("tidemark.llm.ngram_join.BLOCK_BYTES", most)
        assert sorted(ngram_join._counts_of_block(rows, 5, 0.8)) == whole and joined() == classes


def test_memory_of_a_block_of_long_texts(monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(10_000)]
    rows = block_rows([" ".join([*base[k:], *base[:k]]) for k in range(24)])
    monkeypatch.setattr("tidemark.llm.ngram_join.BLOCK_BYTES", 10_000_000)
    tracemalloc.start()
    found = ngram_join._counts_of_block(rows, 5, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    times = [r["times"] for r in rows]
    assert sorted(c for _, c in found) == sorted(sum(times) - t for t in times)
    assert peak < 3 * 10_000_000  # the sets of two runs, and their numbers
    assert len(ngram_join._runs(rows)) > 3


def test_blocks_by_bytes_change_nothing(frame, monkeypatch):
    rng = random.Random(6)
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    rows = list(enumerate(edited(rng, base, rng.choice([0.003, 0.02, 0.04])) for _ in range(40)))
    docs = frame(rows, "doc_id long, text string").repartition(3)
    whole = found(docs, rows)
    monkeypatch.setattr("tidemark.llm.ngram_join.BLOCK_BYTES", 100_000)  # a few texts
    assert found(docs, rows) == whole


def test_rows_of_equal_id_and_text_have_an_order(frame):
    rows = [(1, "a b c d e f", c, [k]) for c in "qxbz" for k in (2, 1)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = frame(rows, "doc_id long, text string, _tm_id string, tags array<long>").repartition(3)
        kept = one_of_each(docs, near_duplicates(docs)).collect()
        assert [tuple(r) for r in kept] == [(1, "a b c d e f", "b", [1])]


def test_short_empty_null_and_repeated(frame):
    rows = [
        (1, "two words"), (2, "Two, WORDS!"), (3, None), (4, ""), (5, "..."), (6, "two words more"), (7, "two words"),
        (8, "é" * 40_000 + " x y z w"), (9, "é" * 40_000 + " x y z w"),
    ]
    got = {r.doc_id: r for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert [got[i].class_id for i in range(1, 10)] == [1, 1, 3, 4, 5, 6, 1, 8, 8]
    assert [got[i].kept for i in range(1, 10)] == [True, False, True, True, True, True, False, True, False]
    assert got[1].n_copies == 2 and got[1].n_links == 1 and got[6].n_links == 0


def test_equal_texts_without_words_are_copies(frame):
    rows = [(1, "..."), (2, "..."), (3, "!"), (4, ""), (5, ""), (6, None), (7, None), (8, "...")]
    got = {r.doc_id: r for r in near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert [got[i].class_id for i in range(1, 9)] == [1, 1, 3, 4, 4, 6, 7, 1]
    assert [got[i].kept for i in range(1, 9)] == [True, False, True, True, False, True, True, False]
    assert [got[i].n_copies for i in range(1, 9)] == [3, 3, 1, 2, 2, 1, 1, 3]
    assert {r.n_links for r in got.values()} == {0}


def test_null_and_repeated_ids_clashing_names_and_empty_table(frame):
    rows = [(None, "a b c d e f g", "x"), (5, "a b c d e f g", "y"), (5, "a b c d e f g", "y"), (None, "only null id here", "z")]
    docs = frame(rows, "doc_id long, text string, kept string")
    near = near_duplicates(docs)
    assert sorted((r.doc_id, r.class_id, r.kept, r.n_copies) for r in near.collect() if r.doc_id) == [(5, 5, True, 3)] * 2
    kept = one_of_each(docs, near).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in kept) == [(0, "z"), (5, "y")]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (301, 300), (300, 301)]
    edges += [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(120)]
    with Scratch(spark, "test") as space:
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), space).collect()}
    up = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(up)):
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    assert got == up
    with Scratch(spark, "test") as space:
        assert components(spark.createDataFrame([], "a long, b long"), space).count() == 0


def test_scratch_tables_are_removed(spark, documents):
    from tidemark.llm.common import scratch

    root = scratch(spark, "x").rsplit("/", 1)[0]
    near_duplicates(documents).count()
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert not [f for f in files if f.getPath().getName().startswith("near-")]
    assert F.lit(1) is not None
