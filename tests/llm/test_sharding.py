import random
import zlib

import pytest

from tidemark.llm.sharding import assign_shards, minimax_capacity, minimax_cuts


def best_capacity(sizes, shards):
    """By dynamic programming over all contiguous partitions."""
    n = len(sizes)
    table = [0] + [float("inf")] * n
    for _ in range(shards):
        table = [0] + [
            min(max(table[j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(1, n + 1)
        ]
    return table[n]


@pytest.mark.parametrize("seed", range(12))
def test_capacity_is_the_smallest(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 2, 5, 40]) * rng.randint(0, 9) for _ in range(rng.randint(1, 14))]
    shards = rng.randint(1, 6)
    capacity = minimax_capacity(sizes, shards)
    assert capacity == best_capacity(sizes, shards)
    cuts = minimax_cuts(sizes, shards)
    assert len(cuts) == shards - 1 and cuts == sorted(cuts)
    ends = [0, *cuts, len(sizes)]
    parts = [sum(sizes[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    assert max(parts) <= capacity and sum(parts) == sum(sizes)


def check(docs, shards=16):
    rows = assign_shards(docs, shards=shards).collect()
    texts = {}
    for r in rows:
        raw = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert texts.setdefault(raw, r.shard) == r.shard
        assert 0 <= r.shard < shards
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    return rows


def test_documents(documents):
    rows = check(documents)
    sums = [sum(r["size"] for r in rows if r.shard == s) for s in range(16)]
    assert max(sums) <= sum(sums) / 16 + max(r["size"] for r in rows)
    assert len(rows) == documents.count()
    again = {r.doc_id: (r.shard, r.slot) for r in assign_shards(documents.repartition(5)).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_copies_nulls_and_clashes(frame):
    rows = [(i, "copy", 1) for i in range(200)] + [(None, None, 2), (None, None, 2), (7, "", 3), (8, "é" * 50_000, 4)]
    found = check(frame(rows, "doc_id long, text string, shard long"))
    assert len(found) == len(rows)
    assert assign_shards(frame([], "doc_id long, text string")).count() == 0


def test_extra_columns_of_any_name(frame):
    names = ["bytes", "_bucket", "_offset", "_place", "key", "id"]
    docs = frame([(i, f"t{i}", *["x"] * len(names)) for i in range(4)],
                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    rows = assign_shards(docs).collect()
    assert len(rows) == 4 and all(r[n] == "x" for r in rows for n in names)
