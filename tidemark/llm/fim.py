"""Fill-in-middle documents by rotating blocks of a byte array in place.

A text is cut behind two of its lines into prefix, middle and suffix. Sentinels are put
in front of the three, and two neighbouring blocks are exchanged by three reversals:
both blocks are reversed apart, then the whole. The same rotation, the other way round,
restores the text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import extended, own

SEED = 7
FIM_PERCENT = 100  # of documents that are cut at all
SPM_PERCENT = 50   # of them with the suffix first
BLOCK = 1 << 16    # bytes that a reversal exchanges at once

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ANY = re.compile(b"|".join((PREFIX, SUFFIX, MIDDLE)))

ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("fim_text", T.StringType()),
    ]
)
RESTORED = T.StructType([T.StructField("restored", T.StringType())])


def reverse(data: bytearray, start: int, end: int) -> None:
    """Reverse the bytes from `start` to `end` in place, holding two blocks at most."""
    view = np.frombuffer(data, np.uint8)
    while end - start > 1:
        n = min(BLOCK, (end - start) // 2)
        head, tail = view[start : start + n], view[end - n : end]
        held = head[::-1].copy()
        head[:] = tail[::-1]
        tail[:] = held
        start, end = start + n, end - n


def rotate(data: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks that meet at `middle`."""
    reverse(data, start, middle)
    reverse(data, middle, end)
    reverse(data, start, end)


class Draw(NamedTuple):
    """Four whole numbers that a document's id draws: two cuts, whether, and which form."""

    first: int
    second: int
    cut: int
    form: int


def draw(doc_id, seed: int = SEED) -> Draw:
    """From the SHA-256 of seed and decimal id; a null id is an empty one."""
    name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    return Draw(*np.frombuffer(hashlib.sha256(name).digest()[:16], ">u4").tolist())


class Cut(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    data: bytearray


def _characters(data: bytearray, start: int, end: int) -> int:
    """Code points: bytes that don't continue one."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8, end - start, start) & 0xC0 != 0x80))


def fill_in_middle(
    text: bytes, drawn: Draw, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> Cut:
    """A text cut behind two of its lines and put in order; plain where it can't be."""
    data = bytearray(text)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if len(data) and (not len(ends) or ends[-1] < len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    if not n or ANY.search(data) or drawn.cut % 100 >= fim_percent:
        return Cut(n, "plain", None, None, data)
    low, high = sorted((drawn.first % (n + 1), drawn.second % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    prefix_chars, middle_chars = _characters(data, 0, a), _characters(data, a, b)
    for at, mark in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):  # from behind, so that places hold
        data[at:at] = mark
    a, b = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)  # where the marks of middle and suffix begin
    if drawn.form % 100 < spm_percent:
        rotate(data, 0, b, len(data))  # suffix before prefix and middle
        return Cut(n, "spm", prefix_chars, middle_chars, data)
    rotate(data, a, b, len(data))  # suffix before middle
    return Cut(n, "psm", prefix_chars, middle_chars, data)


def restore(output: bytes, form: str) -> bytes:
    """The text again, from the output and its form alone."""
    if form == "plain":
        return output
    data = bytearray(output)
    first, second, third = (data.find(m) for m in ((SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)))
    if first != 0 or not first < second < third:
        raise ValueError(f"no output of form {form}")
    if form == "spm":
        rotate(data, 0, second, len(data))
    else:
        rotate(data, second, third, len(data))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = data.find(mark)
        del data[at : at + len(mark)]
    return bytes(data)


def _map(
    docs: DataFrame, inputs: Sequence[str], added: T.StructType, carry: Sequence[str] | None,
    work: Callable[..., list[pa.Array]],
) -> DataFrame:
    """Add columns that `work` makes of the values of some columns, batch by batch."""
    carried, schema = extended(docs, carry, added)
    names = schema.fieldNames()
    made_names = added.fieldNames()
    used = [own(docs, f"_tm_{i}") for i in range(len(inputs))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = dict(zip(made_names, work(*[batch.column(u) for u in used]), strict=True))
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names)

    return docs.select(*carried, *[F.col(c).alias(u) for c, u in zip(inputs, used, strict=True)]).mapInArrow(rows, schema)


def fim_documents(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Add `n`, `form`, `prefix_chars`, `middle_chars` and `fim_text` to every document.

    `n` is the number of lines, each with its line end. Cuts and form come from the hash
    of seed and id, so reruns, copies of a row and other partitions agree; a null id
    counts as an empty one. `form` is "psm" (prefix, suffix, middle), "spm" (suffix,
    prefix, middle) or "plain", where the text stays as it is: an empty or null text
    (an empty output), one that holds a mark, and those beyond `fim_percent`. The
    numbers of characters are null for plain ones. A text takes about three times its
    bytes while it is worked on. One row out for every row in, without a shuffle; an
    empty table gives no rows; columns named like an added one are replaced.
    """

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        cuts = [
            fill_in_middle((t or "").encode(), draw(i, seed), fim_percent, spm_percent)
            for i, t in zip(ids.to_pylist(), texts.to_pylist(), strict=True)
        ]
        return [
            pa.array([c.n for c in cuts], pa.int64()),
            pa.array([c.form for c in cuts], pa.string()),
            pa.array([c.prefix_chars for c in cuts], pa.int64()),
            pa.array([c.middle_chars for c in cuts], pa.int64()),
            pa.array([c.data.decode() for c in cuts], pa.string()),
        ]

    return _map(docs, [doc_id, text], ADDED, carry, work)


def restore_documents(
    docs: DataFrame, fim_text: str = "fim_text", form: str = "form", carry: Sequence[str] | None = None
) -> DataFrame:
    """Add `restored`, the text that `fim_documents` was given (empty for null).

    A null output or form gives null. An output whose marks don't fit its form raises
    ValueError. One row out for every row in; a column named `restored` is replaced.
    """

    def work(outputs: pa.Array, forms: pa.Array) -> list[pa.Array]:
        pairs = zip(outputs.to_pylist(), forms.to_pylist(), strict=True)
        return [
            pa.array(
                [None if o is None or f is None else restore(o.encode(), f).decode() for o, f in pairs],
                pa.string(),
            )
        ]

    return _map(docs, [fim_text, form], RESTORED, carry, work)
