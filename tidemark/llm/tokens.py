"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair tokenizer's encoding of a text is the only row of tokens in which each
token encodes as itself and each two neighbours, encoded together, stay apart. So the
encoding of a prefix ends with the one token that may follow the last token of the
prefix before it. One pass over the characters finds that token and, from it, the
count for every prefix.

No piece of the vocabulary holds a word mark after another character. Encodings are
thus independent from word mark to word mark; the table of a word is computed once
per worker and stored, and prefixes of a text add up those of its words. Totals, cuts
and budgets are read from these tables; no text is encoded again for them.
"""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import extended, own

LIMIT = 4096
CACHED = 500_000  # words whose tables a worker remembers; then it starts anew
MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

ADDED = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
        T.StructField("cut_chars", T.LongType()),
        T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), False)),
    ]
)
ARROW = {
    "n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_(),
    "cut_chars": pa.int64(), "prefix_tokens": pa.list_(pa.int32()),
}


class Prefixes:
    """The token counts of every prefix of one text: tables of its words, one behind the other."""

    def __init__(self, tables: list[Sequence[int]]):
        self.tables = tables
        self.total = sum([t[-1] for t in tables])

    def all(self) -> list[int]:
        """Tokens of every prefix of the normalised text behind its leading mark."""
        out, before = [], 0
        for table in self.tables:
            out += [before + n for n in table[1:]]
            before += table[-1]
        return out

    def longest(self, limit: int) -> int:
        """Characters of the longest prefix of no more than `limit` tokens."""
        sums = list(accumulate(t[-1] for t in self.tables))
        n = bisect_right(sums, limit)
        whole = sum(len(t) - 1 for t in self.tables[:n])
        inside = 0
        if n < len(sums):
            left = limit - (sums[n - 1] if n else 0)
            inside = max((i for i, c in enumerate(self.tables[n]) if c <= left), default=0)
        return max(0, whole + inside - 1)  # the leading mark is not in the text


class PrefixCounter:
    """Token counts of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.library
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                self.score[model.id_to_piece(i)] = model.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("pieces that cross a word mark need another cut")
        self.pieces = ahocorasick.Automaton()
        for piece in self.score:
            self.pieces.add_word(piece, (len(piece), piece))
        self.pieces.make_automaton()
        self.follows: dict[tuple[str, str], bool] = {}
        self.tables: dict[str, Sequence[int]] = {}

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text: best-scored pair first, leftmost among equals."""
        parts, after = list(text), list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (pair := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[pair], i, pair))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= len(parts) or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j], after[i] = pair, "", after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p]

    def _may_follow(self, a: str, b: str) -> bool:
        if len(self.follows) > 600_000:
            self.follows.clear()
        known = self.follows[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def prefixes(self, chunk: str) -> list[int]:
        """Tokens of every prefix of a run between word marks, the empty one first."""
        ends, counts, known = [""], [0], 0
        follows, may_follow = self.follows, self._may_follow
        for end, (length, token) in self.pieces.iter(chunk):  # longest first at each end
            if end < known:
                continue
            while known < end:
                known = self._add_bytes(chunk, known, ends, counts)
            last = ends[end + 1 - length]
            ok = follows.get((last, token))
            if ok if ok is not None else may_follow(last, token):
                ends.append(token)
                counts.append(counts[end + 1 - length] + 1)
                known += 1
        while known < len(chunk):
            known = self._add_bytes(chunk, known, ends, counts)
        return counts

    @staticmethod
    def _add_bytes(chunk: str, known: int, ends: list[str], counts: list[int]) -> int:
        """The next character is in no piece: a token for each of its bytes."""
        ends.append(chunk[known])
        counts.append(counts[-1] + len(chunk[known].encode("utf-8", "surrogatepass")))
        return known + 1

    def _table(self, chunk: str) -> Sequence[int]:
        """The stored table of a word; of short words it stays for later texts."""
        known = self.tables.get(chunk)
        if known is None:
            found = self.prefixes(chunk)
            known = bytes(found) if max(found) < 256 else array("I", found)
            if len(chunk) <= 64:
                if len(self.tables) > CACHED:
                    self.tables.clear()
                self.tables[chunk] = known
        return known

    def chunks(self, text: str) -> list[str]:
        return CHUNK.findall(self.library.normalize(text)) if text else []

    def prefixes_of(self, text: str) -> Prefixes:
        known, chunks = self.tables, self.chunks(text)
        try:
            return Prefixes([known[c] for c in chunks])
        except KeyError:
            return Prefixes([self._table(c) for c in chunks])

    def count(self, text: str) -> int:
        return self.prefixes_of(text).total

    def all_prefixes(self, text: str) -> list[int]:
        """Tokens of every prefix of the normalised text behind its leading mark."""
        return self.prefixes_of(text).all()

    def cut(self, text: str, limit: int) -> int:
        """Characters of the longest prefix that keeps to `limit` tokens."""
        found = self.prefixes_of(text)
        return len(text) if found.total <= limit else found.longest(limit)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of this worker process."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def count_tokens(
    docs: DataFrame,
    model: str,
    text: str = "text",
    limit: int = LIMIT,
    prefixes: bool = False,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Add `n_bytes`, `n_tokens`, `over_limit`, `cut_chars` and, if asked, `prefix_tokens`.

    `model` is the path of a sentencepiece BPE model on every executor. `cut_chars`
    is the number of characters to which a text has to be cut to keep to `limit`
    tokens, found in the counts of its prefixes; the whole length where it keeps to
    it. `prefix_tokens` has the count of every prefix, the first for one character
    (the mark before the text is part of it); `tokens_within` and `chars_within` answer
    questions from it later. Null and empty text: no tokens.
    A row out for every row in, without a shuffle; columns named like an added one
    are replaced.
    """
    at = own(docs, "_tm_text")
    added = T.StructType([f for f in ADDED if prefixes or f.name != "prefix_tokens"])
    carried, schema = extended(docs, carry, added)
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(model)
        for batch in batches:
            made = {f.name: [] for f in added}
            for value in batch.column(at).to_pylist():
                value = value or ""
                found = tool.prefixes_of(value)
                n = found.total
                made["n_bytes"].append(len(value.encode()))
                made["n_tokens"].append(n)
                made["over_limit"].append(n > limit)
                made["cut_chars"].append(found.longest(limit) if n > limit else len(value))
                if prefixes:
                    made["prefix_tokens"].append(found.all()[1:] if value else [])
            arrays = {k: pa.array(v, ARROW[k]) for k, v in made.items()}
            yield pa.RecordBatch.from_arrays(
                [arrays[c] if c in arrays else batch.column(c) for c in names], names
            )

    return docs.select(*carried, F.col(text).alias(at)).mapInArrow(work, schema)


def tokens_within(prefix_tokens: Column, chars: Column) -> Column:
    """Tokens of the first `chars` characters, from a stored `prefix_tokens`.

    Beyond the end it is the count of the whole text; 0 for no or fewer characters and for
    empty texts, null where either is null.
    """
    size = F.size(prefix_tokens)
    at = F.when(chars < size, chars).otherwise(size).cast("int")  # `least` would pass over a null
    count = F.when(at >= 1, F.element_at(prefix_tokens, F.greatest(at, F.lit(1)))).otherwise(0)
    return F.when(prefix_tokens.isNotNull() & chars.isNotNull(), count)


def chars_within(prefix_tokens: Column, budget: Column) -> Column:
    """Characters of the longest prefix of no more than `budget` tokens, from a stored `prefix_tokens`.

    0 where none keeps to it, null where either is null.
    """
    fits = F.array_max(F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i + 1).otherwise(0)))
    return F.when(prefix_tokens.isNotNull() & budget.isNotNull(), F.coalesce(fits, F.lit(0)))
