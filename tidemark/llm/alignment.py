"""Tokens of two tokenizers linked through the bytes they share, over a whole corpus.

Long documents are cut into byte ranges that are tokenized in different tasks; their
fragments (`fragments`) are composed by a tree of grouped tasks until one is left for
each document. Short documents are composed where they are read.

How many documents hold a pair of ids linked comes from sums in three steps: documents of
a batch (some megabytes of text) are counted in the task that reads them, batches by an
aggregate. The counts go back the same way: to each batch those of its own pairs, so no
task needs them all, and no row is made for each document and pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, extended, own
from tidemark.llm.fragments import (
    B_BITS, UNLINKED, Fragment, Linked, TwoTokenizers, byte_ranges, compose_all, groups_of, linked, read_groups,
)

RANGE_BYTES = 1 << 15   # longer texts are cut into ranges of as much
BATCH_BYTES = 8_000_000  # text whose pairs are counted together
FAN = 8                 # fragments that one step of the tree composes
PAIRS_OUT = 100_000
ROWS_HELD = 500         # rows that a task hands on at once
BLOCK_CHARS = 250_000   # text whose words are looked up together

ADDED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [T.StructField("groups_sha256", T.StringType())]
)
LOW = (1 << B_BITS) - 1
PACKER = pa.Codec("zstd", compression_level=1)

_tools: dict[tuple[str, str], TwoTokenizers] = {}


def tool(path_a: str, path_b: str) -> TwoTokenizers:
    """The tokenizers of this worker process."""
    if (path_a, path_b) not in _tools:
        _tools[path_a, path_b] = TwoTokenizers(path_a, path_b)
    return _tools[path_a, path_b]


def pack(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Pairs in order, as differences, and a number for each: how many pairs, then both packed."""
    both = np.concatenate([np.diff(codes, prepend=0), times]).astype("<i8").tobytes()
    return len(codes).to_bytes(8, "little") + PACKER.compress(both, asbytes=True)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = int.from_bytes(data[:8], "little")
    both = np.frombuffer(PACKER.decompress(data[8:], half * 16, asbytes=True), "<i8")
    return np.cumsum(both[:half]), both[half:]


# What is stored of documents (total false), and after each batch its pairs' documents.
STORED = "batch long, total boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
STORED_NAMES = [c.split()[0] for c in STORED.split(", ")]
STORED_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.binary()]


class Batches:
    """Rows to store, and the documents of every pair of a batch."""

    def __init__(self, kind: int, batch_bytes: int, carried: pa.DataType):
        self.base, self.kind, self.batch_bytes = TaskContext.get().partitionId() << 24, kind, batch_bytes
        self.sequence, self.bytes = 0, 0
        self.codes: list[np.ndarray] = []  # of the batch's documents, each code once a document
        self.rows: list[tuple] = []
        self.kept: list = []
        self.type = carried

    @property
    def batch(self) -> int:
        return (self.base + self.sequence) * 2 + self.kind

    def add(self, carried, n_bytes: int, groups: bytes, found: Linked) -> None:
        digest = hashlib.sha256(groups).hexdigest() if groups else ""
        self.rows.append((self.batch, False, *found[:4], digest, pack(found.codes, found.times)))
        self.kept.append(carried)
        self.codes.append(found.codes)
        self.bytes += n_bytes
        if self.bytes >= self.batch_bytes:
            self.close()

    def close(self) -> None:
        if self.bytes:
            documents = np.unique(np.concatenate(self.codes), return_counts=True)
            self.rows.append((self.batch, True, *[None] * 5, pack(*documents)))
            self.kept.append(None)
            self.sequence, self.bytes, self.codes = self.sequence + 1, 0, []

    def out(self, least: int = ROWS_HELD) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), STORED_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(self.kept, self.type)], [*STORED_NAMES, "carried"])
            self.rows, self.kept = [], []

    def end(self) -> Iterator[pa.RecordBatch]:
        self.close()
        yield from self.out(1)


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """The texts of some rows of about `BLOCK_CHARS` together, and those rows."""
    texts, chars, start = [], 0, 0
    for i, body in enumerate(batch.column("body"), 1):
        texts.append(body.as_py())
        chars += len(texts[-1])
        if chars >= BLOCK_CHARS or i == batch.num_rows:
            yield texts, batch.slice(start, i - start)
            texts, chars, start = [], 0, i


def align_tokens(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    carry: Sequence[str] | None = None,
    range_bytes: int = RANGE_BYTES,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Add `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    A is a byte-level tokenizers file, B a sentencepiece model with byte fallback, both
    paths on every executor; both see a space before the text, special strings in texts
    are plain text. Places where tokens of both end cut a text into groups; a link is a
    token of A and one of B in the same group. A pair of ids counts the documents that
    hold it linked; `n_best` are the links whose count is the highest of their A id,
    ties included, `count_sum` adds up the counts of all links. `groups_sha256` is over
    `a1,a2|b1;a3|b2`, '' without tokens.

    Null and empty texts, and those that a tokenizer doesn't give back byte by byte,
    have no tokens: zeros. Repeated rows are documents of their own. An empty table
    gives no rows. Columns named like an added one are replaced.
    """
    carried, _ = extended(docs, carry, ADDED)
    spark, number = docs.sparkSession, own(docs, "_tm_row")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
        F.struct(F.monotonically_increasing_id().alias(number), *[F.col(f"`{c}`") for c in carried]).alias("carried"),
    )
    is_long = F.octet_length("body") > range_bytes
    stored = T.StructType([*T.StructType.fromDDL(STORED), T.StructField("carried", rows.schema["carried"].dataType)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, made = tool(path_a, path_b), None
        for batch in batches:
            made = made or Batches(0, batch_bytes, batch.column("carried").type)
            for texts, some in blocks(batch):
                for text, held, found in zip(texts, some.column("carried"), both.texts(texts), strict=True):
                    made.add(held.as_py(), len(text) + 1, *(found or (b"", UNLINKED)))
                    yield from made.out()
        if made:
            yield from made.end()
        both.forget()
        pa.default_memory_pool().release_unused()  # workers wait for tasks of later stages

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            made = made or Batches(1, batch_bytes, batch.column("carried").type)
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                groups = "" if row["bad"] else groups_of(Fragment(row["prefix"], row["closed"], row["suffix"]))
                made.add(row["carried"], len(groups) + 1, groups.encode(), linked(read_groups(groups)))
                yield from made.out()
        if made:
            yield from made.end()

    with Scratch(spark, "alignment") as kept:
        whole = _composed(kept, rows.filter(is_long), path_a, path_b, range_bytes)
        documents = kept.table(
            rows.filter(~is_long).select("body", "carried").mapInArrow(read, stored).unionByName(
                whole.mapInArrow(finish, stored)
            )
        )
        result = _with_counts(kept, documents)
        out = kept.result(
            result.select(*[F.col(f"carried.`{c}`") for c in carried], *ADDED.fieldNames())
        )
    return out


def _composed(kept: Scratch, rows: DataFrame, path_a: str, path_b: str, range_bytes: int) -> DataFrame:
    """One fragment for each row, of byte ranges that different tasks have tokenized.

    The ranges are written first, with the words that reach into them, and then dealt to
    tasks by row and range. A step of the tree composes `FAN` neighbours in one group.
    """
    carried = T.StructField("carried", rows.schema["carried"].dataType)  # null but in the first range
    cut_to = T.StructType([*T.StructType.fromDDL("row long, piece long, start long, end long, words string"), carried])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tool(path_a, path_b)
        for batch in batches:
            types = batch.column("carried").type
            for row, body, held in zip(*(batch.column(c) for c in ("row", "body", "carried")), strict=True):
                for piece, (words, start, end) in enumerate(byte_ranges(both.words_of(body.as_py()), range_bytes)):
                    one = [row.as_py(), piece, start, end, words, held.as_py() if piece == 0 else None]
                    yield _row_out(one, cut_to.fieldNames(), [pa.int64()] * 4 + [pa.string(), types])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, names = tool(path_a, path_b), parts.fieldNames()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                found = both.range_of(*(one.column(c)[0].as_py() for c in ("words", "start", "end")))
                made = {
                    "bad": pa.array([found is None], pa.bool_()),
                    **{c: pa.array([found and getattr(found, c)], pa.string()) for c in Fragment._fields},
                }
                yield pa.RecordBatch.from_arrays([made[c] if c in made else one.column(c) for c in names], names)

    def step(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        rows = group.to_pylist()
        bad = any(r["bad"] for r in rows)
        one = None if bad else compose_all(Fragment(r["prefix"], r["closed"], r["suffix"]) for r in rows)
        values = [rows[0]["row"], rows[0]["piece"] // FAN, bad, *(one or [None] * 3), rows[0]["carried"]]
        return pa.Table.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, group.schema, strict=True)], schema=group.schema
        )

    ranges = kept.table(rows.select("row", "body", "carried").mapInArrow(cut, cut_to))
    told = "row long, piece long, bad boolean, prefix string, closed string, suffix string"
    parts = T.StructType([*T.StructType.fromDDL(told), ranges.schema["carried"]])
    last = ranges.agg(F.max("piece")).first()[0] or 0
    found = ranges.repartition("row", "piece").mapInArrow(tokenize, parts)
    while last > 0:
        above = F.floor(F.col("piece") / FAN)
        found = found.groupBy("row", above.alias("above")).applyInArrow(step, parts)
        last //= FAN
    return found


def _row_out(values: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def _with_counts(kept: Scratch, documents: DataFrame) -> DataFrame:
    """Add to stored documents what the corpus says of their pairs."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes, n = unpack(data)
                for i in range(0, len(codes), PAIRS_OUT):
                    some = codes[i : i + PAIRS_OUT]
                    columns = [np.full(len(some), name), some >> B_BITS, some & LOW, n[i : i + PAIRS_OUT]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["batch", "a", "b", "n"])

    totals = documents.filter("total").select("batch", "pairs")
    pairs = kept.table(totals.mapInArrow(spread, "batch long, a long, b long, n long"))
    of_a = Window.partitionBy("a")  # as many rows as B has ids at most
    counts = kept.table(
        pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
        .withColumn("best", F.col("count") == F.max("count").over(of_a))
    )
    known = pairs.drop("n").join(counts, ["a", "b"])
    schema = T.StructType([documents.schema["carried"], *ADDED])

    def meet(stored: pa.Table, known: pa.Table) -> pa.Table:
        a, b, count, best = (known.column(c).to_numpy() for c in ("a", "b", "count", "best"))
        codes = a << B_BITS | b
        order = np.argsort(codes)
        codes, count, best = codes[order], count[order], best[order].astype(bool)
        n_best, sums = [], []
        for data in stored.column("pairs").to_pylist():
            mine, times = unpack(data)
            at = np.searchsorted(codes, mine)
            n_best.append(int(times[best[at]].sum()) if len(mine) else 0)
            sums.append(int((times * count[at]).sum()) if len(mine) else 0)
        made = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        names = schema.fieldNames()
        return pa.Table.from_arrays([made[c] if c in made else stored.column(c) for c in names], names)

    by_batch = documents.filter("not total").drop("total").groupBy("batch")
    return by_batch.cogroup(known.groupBy("batch")).applyInArrow(meet, schema)
