"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are runs of ASCII digits, letters (A-Z lower-cased) and code points beyond
ASCII. Every distinct benchmark word gets one character, so a window of ten words
is a string of ten characters and a document a string with one character per word;
words that no benchmark has share one character that no pattern holds. The scan is
then one pass of the automaton over the document, and a match is a range of words,
which is mapped back to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD_BYTES, extended, own

WINDOW = 10
PART_BYTES = 2_000_000  # benchmark text per automaton, about 200 MB in a worker

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType(), False)),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]),
                False,
            ),
        ),
        T.StructField("contaminated", T.BooleanType()),
    ]
)
ARROW = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "items": pa.list_(pa.string()),
    "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
    "contaminated": pa.bool_(),
}


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(WORD_BYTES).split() if raw else []


def _character(i: int) -> str:
    """The i-th character for a word: neither NUL nor a surrogate."""
    return chr(i + 1 if i + 1 < 0xD800 else i + 0x801)


class Matcher:
    """The windows of some items; the automaton is built where it is first used."""

    def __init__(self, items: Sequence[tuple[str, bytes | None]], window: int):
        self.window, self.letters, self.patterns = window, {}, {}
        for item, raw in items:
            coded = "".join(
                self.letters.setdefault(w, _character(len(self.letters))) for w in words_of(raw)
            )
            for i in range(max(1, len(coded) - window + 1)) if coded else ():
                self.patterns.setdefault(coded[i : i + window], set()).add(item)

    def __getstate__(self):
        return {"window": self.window, "letters": self.letters, "patterns": self.patterns}

    def _automaton(self):
        if "automaton" not in self.__dict__:
            made = ahocorasick.Automaton()
            for pattern, items in self.patterns.items():
                made.add_word(pattern, (len(pattern), items))
            made.make_automaton()
            self.automaton = made
        return self.automaton

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint ranges of hit words, end excluded, and the items found."""
        if not self.patterns or not words:
            return [], set()
        get = self.letters.get
        coded = "".join([get(w, "\0") for w in words])
        ranges, items = [], set()
        for end, (length, found) in self._automaton().iter(coded):
            ranges.append((end + 1 - length, end + 1))
            items |= found
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def spans_of(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Ranges of words as ranges of code points of the original text."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    out, seen, at = [], 0, 0
    for first, last in ranges:
        start, end = places[first][0], places[last - 1][1]
        at += len(raw[seen:start].decode("utf-8", "replace"))
        long = len(raw[start:end].decode("utf-8", "replace"))
        out.append({"start": at, "end": at + long})
        at, seen = at + long, end
    return out


def _parts(benchmark: DataFrame, item_id: str, item_text: str, part_bytes: int) -> Iterator[list]:
    """The items in parts of about `part_bytes`, one part at the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.col(item_text).cast("binary").alias("raw"),
    )
    total = items.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n = -(-total // part_bytes) or 1
    for part in range(n):
        rows = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "raw"), F.lit(n)) == part)
        yield [(r["item"], bytes(r["raw"]) if r["raw"] is not None else None) for r in rows.collect()]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    carry: Sequence[str] | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Mark the words of every document that lie in a window of a benchmark item.

    A window is `window` consecutive words of an item, or the whole item where it
    has fewer, but not none. Adds `n_words`, `n_hit` (words inside a window found),
    `items` (ids as strings, sorted), `spans` (code points of the original text, end
    excluded) and `contaminated` (n_hit > 0) to the columns in `carry` (all if None).

    No shuffle; whole texts; a row in gives a row out, repeated rows and null ids
    included. Null and empty text: 0 words, not contaminated. An item with a null id
    has the id "". An empty benchmark marks nothing. Input columns named like an added
    one are replaced. A benchmark of more than `part_bytes` is scanned for in several
    automata, one after the other, with the same result.
    """
    spark = docs.sparkSession
    at = own(docs, "_tm_raw")
    carried, schema = extended(docs, carry, ADDED)
    names = schema.fieldNames()
    out = docs.select(*carried, F.col(text).cast("binary").alias(at))
    first = True
    for items in _parts(benchmark, item_id, item_text, part_bytes):
        shared = spark.sparkContext.broadcast(Matcher(items, window))
        out = out.mapInArrow(
            _scan(shared, first, names, at),
            T.StructType([*schema, T.StructField(at, T.BinaryType())]),
        )
        first = False
    return out.select(*names)


def _scan(shared, first: bool, names: list[str], at: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value
        for batch in batches:
            raws = batch.column(at).to_pylist()
            made = {k: [] for k in ARROW}
            earlier = [None] * len(raws) if first else zip(
                batch.column("items").to_pylist(), batch.column("spans").to_pylist(),
                batch.column("n_hit").to_pylist(), strict=True,
            )
            for raw, before in zip(raws, earlier, strict=True):
                words = words_of(raw)
                ranges, items = matcher.find(words)
                if before and before[2]:
                    ranges = merged(ranges + _ranges(raw, before[1]))
                    items |= set(before[0])
                hit = sum(b - a for a, b in ranges)
                made["n_words"].append(len(words))
                made["n_hit"].append(hit)
                made["items"].append(sorted(items))
                made["spans"].append(spans_of(raw, ranges) if ranges else [])
                made["contaminated"].append(hit > 0)
            arrays = {k: pa.array(v, ARROW[k]) for k, v in made.items()}
            columns = [arrays[n] if n in arrays else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(at)], [*names, at])

    return scan


def _ranges(raw: bytes, spans: list[dict[str, int]]) -> list[tuple[int, int]]:
    """Spans of code points as ranges of words, the inverse of `spans_of`."""
    text = raw.decode("utf-8", "replace")
    count = lambda s: len(words_of(s.encode()))
    return [(n := count(text[: s["start"]]), n + count(text[s["start"] : s["end"]])) for s in spans]
