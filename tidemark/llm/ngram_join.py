"""Near copies: an n-gram Jaccard join by banded MinHash, verified on full n-gram sets.

1. Every text gets MinHash values, cut into bands of rows whose counts follow from the
   wanted recall. Texts that agree on a band meet in its bucket.
2. No bucket is expanded into pairs. Each bucket has a leader: its most central text,
   the one whose own buckets hold most texts. All others are compared with the leader
   on their full sets of word n-grams. The links found give classes.
3. What a leader can't decide, two other texts of a bucket in different classes, is
   compared as well, in blocks of bounded size, each pair only in the first bucket that
   it shares. So every pair that shares a bucket is either in one class or was compared.
   Blocks are as many as the number of texts or what their sets take in memory asks for.
4. When the classes are known, all texts of a class are compared with each other, in pairs
   of blocks of bounded size, and only the number of links of each text leaves a task.
   Texts of equal words are one there, with the number of texts that it stands for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, Scratch, own
from tidemark.llm.components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 128
BLOCK = 512  # texts of a bucket or class that one task compares with as many others, if they are short
BLOCK_BYTES = 128_000_000  # about what the n-gram sets of a block may take in a worker; a larger text is alone
GRAM_BYTES = 200  # of an n-gram in a set, besides its text
COLUMNS = 4096  # n-grams of a block that are multiplied at once

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def bands_and_rows(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """The longest bands that find a pair at the threshold with the wanted recall.

    A pair of similarity s shares a band of r rows with probability s**r, and at least
    one of b bands with 1 - (1 - s**r)**b.
    """
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Band hashes of a text's n-grams."""

    def __init__(self, n: int, bands: int, rows: int):
        self.n, self.bands, self.rows = n, bands, rows
        seeds = _mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * _MULTIPLIER)
        self.a, self.b = seeds[: bands * rows] | np.uint64(1), seeds[bands * rows :]
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _grow(self, size: int) -> None:
        """Powers of the multiplier, and of its inverse modulo 2**64."""
        if len(self.powers) >= size:
            return
        size = max(size, 1 << 17)
        for name, base in (("powers", _MULTIPLIER), ("inverses", np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64)))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            setattr(self, name, np.multiply.accumulate(table))

    def grams(self, words: list[bytes]) -> np.ndarray:
        """A 64-bit hash of each n-gram; the one of all words where there are fewer."""
        data = np.frombuffer(b" ".join(words), np.uint8)
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        gaps = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], gaps + 1))
        ends = np.concatenate((gaps, [len(data)]))
        k = min(self.n, len(starts))
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
        return _mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def band_hashes(self, words: list[bytes]) -> np.ndarray:
        grams = self.grams(words)
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(grams), 1024):
            np.minimum(least, (grams[i : i + 1024, None] * self.a + self.b).min(axis=0), out=least)
        rows = least.reshape(self.bands, self.rows)
        out = np.arange(1, self.bands + 1, dtype=np.uint64) * _MULTIPLIER
        for r in range(self.rows):
            out = _mixed(out ^ rows[:, r]) * _MULTIPLIER
        return out.view(np.int64)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(WORD_BYTES).split() if raw else []


def gram_set(raw: bytes, n: int) -> frozenset[bytes]:
    """The full n-grams of a text, as they are."""
    words = words_of(raw)
    return frozenset(b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def similar(a: frozenset, b: frozenset, threshold: float) -> bool:
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    shared = len(a & b)
    return shared >= threshold * (len(a) + len(b) - shared)


def _signatures(n: int, bands: int, rows: int):

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n, bands, rows)
        for batch in batches:
            found, sizes, weights, said = [], [], [], []
            for raw in batch.column("raw").to_pylist():
                words = words_of(raw)
                sizes.append(None if raw is None else max(1, len(words) - n + 1) if words else 0)
                weights.append(0 if raw is None else GRAM_BYTES * sizes[-1] + n * len(raw))
                found.append(hasher.band_hashes(words) if words else None)
                said.append(hashlib.md5(b" ".join(words), usedforsecurity=False).digest())
            empty = np.zeros(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([0 if f is None else bands for f in found]))).astype(np.int32)
            values = np.concatenate([empty, *(f for f in found if f is not None)])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("key"), pa.array(said, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.array(weights, pa.int64()), lists,
                ],
                ["id", "key", "said", "grams", "weight", "bands"],
            )

    return work


def _verify_stars(n: int, threshold: float):
    """Rows (a, b, text of a, text of b), those of one leader b mostly together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of_held = None, frozenset()
        for batch in batches:
            a, b, left, right = (batch.column(c).to_pylist() for c in ("a", "b", "left", "right"))
            passed = []
            for x, y, s, t in zip(a, b, left, right, strict=True):
                if y != held:
                    held, of_held = y, gram_set(t, n)
                if similar(gram_set(s, n), of_held, threshold):
                    passed.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in passed], pa.binary()) for i in (0, 1)], ["a", "b"]
            )

    return work


class _Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x, y) -> None:
        self.up[self.find(x)] = self.find(y)


def _runs(rows: list[dict]) -> list[range]:
    """Places of rows whose sets fit into `BLOCK_BYTES` together, a larger one alone."""
    out, low, held = [], 0, 0
    for i, r in enumerate(rows):
        if held and held + r["weight"] > BLOCK_BYTES:
            out.append(range(low, i))
            low, held = i, 0
        held += r["weight"]
    return [*out, range(low, len(rows))]


def _links_of_block(rows: list[dict], n: int, threshold: float) -> Iterator[tuple[bytes, bytes]]:
    """Links between texts of different classes in a pair of blocks (or one with itself).

    Only the sets of two runs of texts are held at once.
    """
    first = [r for r in rows if r["block"] == rows[0]["i"]]
    second = first if rows[0]["i"] == rows[0]["j"] else [r for r in rows if r["block"] == rows[0]["j"]]
    if not first or not second:
        return
    classes, sets = _Union(), {}

    def grams(r: dict) -> frozenset[bytes]:
        if r["key"] not in sets:
            sets[r["key"]] = gram_set(r["raw"], n)
        return sets[r["key"]]

    mine = np.array([r["bands"] for r in second])
    where = int(np.flatnonzero(mine[0] == rows[0]["band"])[0])
    for left in _runs(first):
        for right in _runs(second):
            if second is first and right[-1] < left[0]:
                continue
            sets.clear()
            theirs = mine[right[0] : right[-1] + 1]
            for k in left:
                r = first[k]
                # pairs that share no earlier band than this one
                known = np.array(r["bands"][:where])
                earlier = (theirs[:, :where] == known).any(axis=1) if where else np.zeros(len(right), bool)
                for j in np.flatnonzero(~earlier) + right[0]:
                    s = second[j]
                    if second is first and j <= k or classes.find(r["component"]) == classes.find(s["component"]):
                        continue
                    if similar(grams(r), grams(s), threshold):
                        classes.join(r["component"], s["component"])
                        yield r["key"], s["key"]


def _verify_blocks(n: int, threshold: float):
    """Rows sorted by band and pair of blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, group in groupby(rows, lambda r: (r["band"], r["i"], r["j"])):
            links = list(_links_of_block(list(group), n, threshold))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in links], pa.binary()) for k in (0, 1)], ["a", "b"]
                )

    return work


def _shared(sets: list[frozenset], first: slice, second: slice) -> np.ndarray:
    """How many elements each set of `first` has in common with each of `second`."""
    number: dict = {}
    members = [np.fromiter((number.setdefault(g, len(number)) for g in s), np.int64, len(s)) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(m) for m in members])
    column = np.concatenate(members)
    often = np.bincount(column, minlength=len(number)) > 1  # others are in no two sets
    place = np.cumsum(often) - 1
    row, column = row[often[column]], place[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets[first]), len(sets[second])))
    for low in range(0, int(often.sum()), COLUMNS):
        here = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        table = np.zeros((len(sets), COLUMNS), np.float32)  # counts up to COLUMNS are exact
        table[row[here], column[here] - low] = 1
        out += table[first] @ table[second].T
    return out


def _counts_of_block(rows: list[dict], n: int, threshold: float) -> list[tuple[bytes, int]]:
    """Texts of a pair of blocks (or one with itself), and how many texts are similar to each.

    Only the sets of two runs of texts are held at once.
    """
    one = rows[0]["i"] == rows[0]["j"]
    left = [r for r in rows if r["block"] == rows[0]["i"]]
    right = left if one else [r for r in rows if r["block"] != rows[0]["i"]]
    counts: dict[bytes, int] = {}
    for a in _runs(left):
        for b in _runs(right):
            if one and b.start < a.start or not a or not b:
                continue
            for key, c in _counts_of_runs([left[k] for k in a], [] if one and a == b else [right[k] for k in b], n, threshold):
                counts[key] = counts.get(key, 0) + c
    return list(counts.items())


def _counts_of_runs(left: list[dict], right: list[dict], n: int, threshold: float) -> list[tuple[bytes, int]]:
    """The same for texts against others, or among themselves if there are no others."""
    every = left + right
    first = slice(0, len(left))
    second = slice(len(left), len(every)) if right else first
    sets = [gram_set(r["raw"], n) for r in every]
    sizes = np.array([len(s) for s in sets], np.float64)
    times = np.array([r["times"] for r in every], np.int64)
    shared = _shared(sets, first, second)
    alike = shared >= threshold * (sizes[first, None] + sizes[None, second] - shared)
    if not right:
        np.fill_diagonal(alike, False)
    counts = np.zeros(len(every), np.int64)
    counts[first] += alike.astype(np.int64) @ times[second]
    if right:
        counts[second] += alike.T.astype(np.int64) @ times[first]
    return [(r["key"], int(c)) for r, c in zip(every, counts, strict=True) if c]


def _count_blocks(n: int, threshold: float):
    """Rows sorted by class and pair of blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        held: list[tuple[bytes, int]] = []

        def out() -> pa.RecordBatch:
            made = [pa.array([k for k, _ in held], pa.binary()), pa.array([c for _, c in held], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(made, ["key", "found"])

        for _, group in groupby(rows, lambda r: (r["component"], r["i"], r["j"])):
            held.extend(_counts_of_block(list(group), n, threshold))
            if len(held) >= 4096:
                yield out()
        yield out()

    return work


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    hashes: int = HASHES,
    block: int = BLOCK,
) -> DataFrame:
    """Per document its class of near copies: one row for every row of `docs`.

    Returns `doc_id`, `text_md5`, `class_id` (smallest document id of the class), `kept`
    (true in the rows of the class's first text with that id), `n_copies` (rows with the
    same text) and `n_links` (all other texts of the class that are linked to this one, by
    a comparison of their full sets). Two texts are linked if the sets of their `n`-word sequences have a
    Jaccard similarity of `threshold` or more; a class is what links connect, and equal
    texts are one. Words are runs of ASCII digits and letters, without case, and code
    points beyond ASCII; a text of fewer than `n` words is one sequence.

    Texts without words are linked to nothing, so only equal ones share a class. Each null
    text is its own class, except that those with an equal id share `kept`. Rows with null ids are members
    like others, but name a class only if it has no other id. An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bands, rows = bands_and_rows(threshold, recall, hashes)
    given = docs.select(
        F.col(doc_id).alias("id"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("key"),
        F.col(text).cast("binary").alias("raw"),
    )
    id_type = given.schema["id"].dataType.simpleString()
    with Scratch(spark, "near") as space:
        members = space.table(
            given.mapInArrow(_signatures(n, bands, rows), f"id {id_type}, key binary, said binary, grams long, weight long, bands array<long>")
        )
        first_id = F.min(F.struct(F.col("id").isNull().alias("none"), "id"))
        nodes = space.table(
            members.filter("grams is not null")
            .groupBy("key")
            .agg(
                first_id.alias("low"), F.count(F.lit(1)).alias("n_copies"),
                F.first("said").alias("said"), F.first("grams").alias("grams"), F.first("weight").alias("weight"),
                F.first("bands").alias("bands"),
            )
        )
        found = _candidates(nodes, space)
        texts = _texts(given, found, space)
        stars = _star_links(found, nodes, texts, n, threshold, space)
        classes = space.table(components(stars, space))
        more = _block_links(found, nodes, texts, classes, n, threshold, block, space)
        if not more.isEmpty():
            classes = space.table(components(stars.union(more), space))
        degree = _link_counts(nodes, texts, classes, n, threshold, block, space)
        return space.result(_described(members, nodes, degree, classes, doc_id))


def _candidates(nodes: DataFrame, space: Scratch) -> DataFrame:
    """Buckets of two or more texts: key, band and the bucket's leader."""
    every = nodes.select("key", F.explode("bands").alias("band"))
    shared = every.groupBy(F.col("band").alias("of")).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    member = space.table(every.join(shared, F.col("band").eqNullSafe(F.col("of"))).drop("of"))
    score = member.groupBy(F.col("key").alias("of")).agg(F.sum("m").alias("score"))
    scored = member.join(score, F.col("key").eqNullSafe(F.col("of"))).drop("of")
    leaders = scored.groupBy(F.col("band").alias("of")).agg(F.max(F.struct("score", "key"))["key"].alias("leader"))
    return space.table(member.join(leaders, F.col("band").eqNullSafe(F.col("of"))).drop("of"))


def _texts(given: DataFrame, found: DataFrame, space: Scratch) -> DataFrame:
    """One row with the text for each key in a bucket.

    Copies are dropped first, in the map-side half of an aggregate, so that the
    shuffle gets a text once per task at most, however many copies it has.
    """
    needed = found.select("key").distinct()
    one = given.filter("raw is not null").select("key", "raw").dropDuplicates(["key"])
    return space.table(one.join(needed, "key", "left_semi"))


def _star_links(found, nodes, texts, n, threshold, space) -> DataFrame:
    """Verified links of texts to the leaders of their buckets."""
    pairs = found.filter("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    left = texts.select(F.col("key").alias("a"), F.col("raw").alias("left"))
    right = texts.select(F.col("key").alias("of"), F.col("raw").alias("right"))
    rows = pairs.join(left, "a").join(right, F.col("b") == F.col("of")).select("a", "b", "left", "right")
    return space.table(rows.mapInArrow(_verify_stars(n, threshold), "a binary, b binary"))


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Each text (`key`, of `m` with sets of `total` bytes) in its block and in pairs with all blocks: `i`, `j`."""
    blocks = F.greatest(F.ceil(F.col("m") / F.lit(block)), F.ceil(F.col("total") / F.lit(BLOCK_BYTES)), F.lit(1))
    return (
        rows.withColumn("blocks", blocks.cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )


def _block_links(found, nodes, texts, classes, n, threshold, block, space) -> DataFrame:
    """Verified links between followers in a bucket whose classes differ."""
    followers = found.filter("key <> leader").select("key", "band", "m")
    known = classes.select(F.col("node").alias("of"), "component")
    placed = followers.join(known, F.col("key").eqNullSafe(F.col("of")), "left").select(
        "key", "band", "m", F.coalesce("component", "key").alias("component")
    )
    placed = space.table(placed)
    open_bands = (
        placed.groupBy(F.col("band").alias("of"))
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("least <> most")
        .select("of")
    )
    weights = nodes.select(F.col("key").alias("of"), "weight")
    among = space.table(
        placed.join(open_bands, F.col("band").eqNullSafe(F.col("of")), "left_semi")
        .join(weights, F.col("key").eqNullSafe(F.col("of"))).drop("of")
    )
    total = among.groupBy(F.col("band").alias("of")).agg(F.sum("weight").alias("total"))
    dealt = _dealt(among.join(total, F.col("band").eqNullSafe(F.col("of"))), block).select(
        "key", "band", "component", "weight", "block", "i", "j"
    )
    details = texts.join(nodes.select("key", "grams", "bands"), "key").withColumnRenamed("key", "of")
    rows = (
        dealt.join(details, F.col("key") == F.col("of"))
        .drop("of")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
    )
    return space.table(rows.mapInArrow(_verify_blocks(n, threshold), "a binary, b binary"))


def _link_counts(nodes, texts, classes, n, threshold, block, space) -> DataFrame:
    """Verified links of every text (`of`) with others of its class: `n_links`.

    Texts of equal words have equal sets, so the one of the lowest key is compared for
    all of them. A class of m such texts is dealt to pairs of blocks, each text to every
    block once: rows grow with m * m / block (with long texts, with the number of blocks that
    their sets ask for), and no pair leaves a task.
    """
    known = classes.select(F.col("node").alias("of"), "component")
    member = nodes.select("key", "said", "weight").join(known, F.col("key").eqNullSafe(F.col("of"))).drop("of")
    one = space.table(
        member.groupBy("component", "said").agg(
            F.min("key").alias("key"), F.count(F.lit(1)).alias("times"), F.max("weight").alias("weight")
        )
    )
    sizes = (
        one.groupBy(F.col("component").alias("of"))
        .agg(F.count(F.lit(1)).alias("m"), F.sum("weight").alias("total"))
        .filter("m > 1")
    )
    dealt = _dealt(one.join(sizes, F.col("component").eqNullSafe(F.col("of"))), block).select(
        "component", "key", "times", "weight", "block", "i", "j"
    )
    rows = (
        dealt.join(texts.withColumnRenamed("key", "of"), F.col("key").eqNullSafe(F.col("of")))
        .drop("of")
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
    )
    counted = rows.mapInArrow(_count_blocks(n, threshold), "key binary, found long")
    found = space.table(counted.groupBy(F.col("key").alias("of")).agg(F.sum("found").alias("found")))
    total = one.join(found, F.col("key").eqNullSafe(F.col("of")), "left").select(
        F.col("said").alias("of"), (F.coalesce("found", F.lit(0)) + F.col("times") - 1).alias("n_links")
    )
    return nodes.select("key", "said").join(total, F.col("said").eqNullSafe(F.col("of"))).select(
        F.col("key").alias("of"), "n_links"
    )


def _described(members, nodes, degree, classes, doc_id: str) -> DataFrame:
    known = classes.select(F.col("node").alias("of"), "component")
    classed = (
        nodes.select("key", "low", "n_copies")
        .join(known, F.col("key").eqNullSafe(F.col("of")), "left")
        .select("key", "low", "n_copies", F.coalesce("component", "key").alias("component"))
    )
    first = classed.groupBy(F.col("component").alias("of")).agg(F.min(F.struct("low", "key")).alias("first"))
    info = (
        classed.join(first, F.col("component").eqNullSafe(F.col("of")))
        .drop("of")
        .join(degree, F.col("key").eqNullSafe(F.col("of")), "left")
        .select(
            F.col("key").alias("of"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.col("first.low.id").alias("class_id"), F.col("first.key").alias("first_key"),
        )
    )
    alone = F.col("grams").isNull()
    row = members.join(info, F.col("key").eqNullSafe(F.col("of")), "left")
    kept = alone | ((F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("class_id")))
    return row.select(
        F.col("id").alias(doc_id),
        F.lower(F.hex("key")).alias("text_md5"),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        kept.alias("kept"),
        F.when(alone, F.lit(1)).otherwise(F.col("n_copies")).alias("n_copies"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, near: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stand for their class in `near`, all columns unchanged.

    Rows equal in id and text are one row here; the one stays whose columns are first as JSON. An
    empty table gives no rows. Input columns may have any names.
    """
    at_id, at_md5, at_row = (own(docs, f"_tm_{c}") for c in ("id", "md5", "row"))
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    chosen = near.filter("kept").select(name.alias(at_id), F.col("text_md5").alias(at_md5)).distinct()
    md5 = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.withColumns({at_id: name, at_md5: md5}).join(chosen, [at_id, at_md5], "left_semi")
    rest = [F.col(c) for c in docs.columns if c != text] + [F.col(text).isNull().alias(at_row)]
    first = F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*rest)))
    return rows.groupBy(at_id, at_md5).agg(first.alias(at_row)).select(f"{at_row}.*")
