"""Token ids of documents in binary files, in the order of document ids.

A file is one run of ids of equal width, with the ends of its documents and their ids as
Elias-Fano numbers. Files are committed by Spark's text writer, one record each, so lost
tasks leave nothing behind; the line end after the record is no part of the format. The
folder names tell how many documents and ids a file holds, so that readers know where
each file begins in the whole without opening any.

Layout of a file, numbers little-endian:
  8 bytes   TMTOKENS
  1 byte    width of an id: 2 or 4 bytes
  8 bytes   documents without an id, which come first
  8 bytes   smallest document id
  numbers   ends of documents, counted in ids from the start of the file
  numbers   document ids less the smallest, those without an id left out
  rest      token ids
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Recent
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.fragments import byte_alphabet

MAGIC = b"TMTOKENS"
HEAD = struct.Struct("<8sBQq")
SHARD_BYTES = 16_000_000  # a file is closed when its ids take as much
SEQUENCE_BITS = 24        # files of one task
CACHED = 200_000          # runs, and parts of runs, whose ids a worker remembers at least; up to twice as many
CACHED_CHARS = 64
ROWS_OUT = 2_000

# Fixed white space at which any tokenizer that drops white space may be cut.
RUN = re.compile(r"[^ \t\n\r]+")
# Fixed: how tokenizers of one kind prepare texts, and what that means for runs of
# printable ASCII and letters of Latin-1, which normalization leaves as they are.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff \t\n\r]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff \t\n\r]+")


class RunEncoder:
    """Ids of texts under a tokenizer of which no token reaches over white space.

    A plain text falls into parts as the tokenizer would split it, and the library's
    model merges each part once per worker. Other texts are cut at spaces, tabs and line
    ends into runs; those that aren't plain go to the library. That equals encoding
    whole texts when the tokenizer drops white space before it merges, which is tried
    on a few texts.
    """

    PROBES = ("a b", "a\tb", "a\n\nb \r c", "it's  12 !! x", "é é ΑΣ Σ.   z", "中 文 ab,c d")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.type, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.runs, self.parts = Recent(CACHED), Recent(CACHED)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        steps = (told["normalizer"] or {}).get("normalizers", []), (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [[s["type"] for s in row] for row in steps]
        self.split = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and (
            steps[1][0]["pattern"], steps[1][0]["behavior"], steps[1][0]["invert"],
            steps[1][1]["add_prefix_space"], steps[1][1]["use_regex"],
        ) == ({"Regex": SPLIT}, "Removed", True, False, False)
        special = [t["content"] for t in told["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) if special else "(?!)")
        shown = {b: c for c, b in byte_alphabet().items()}
        self.byte_level = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x21, 0x100)}
        for probe in self.PROBES:
            if self.encode(probe) != self._whole([probe])[0]:
                raise ValueError(f"{path} has tokens over white space")

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in found]

    def _is_plain(self, text: str) -> bool:
        return self.split and PLAIN.fullmatch(text) is not None and not self.special.search(text)

    def _by_parts(self, text: str) -> bytes:
        parts = PARTS.findall(text.lower())
        unseen = self.parts.missing(dict.fromkeys(parts))
        merge, spelt, code = self.library.model.tokenize, self.byte_level, self.code
        made = {p: array(code, [t.id for t in merge(p.translate(spelt))]).tobytes() for p in unseen}
        known = self.parts.new
        out = b"".join([known[p] if p in known else made[p] for p in parts])
        self.parts.keep({p: ids for p, ids in made.items() if len(p) <= CACHED_CHARS})
        return out

    def encode(self, text: str) -> bytes:
        if self._is_plain(text):
            return self._by_parts(text)
        runs = RUN.findall(text)
        unseen = self.runs.missing(dict.fromkeys(runs))
        known, made = self.runs.new, {r: self._by_parts(r) for r in unseen if self._is_plain(r)}
        other = [r for r in unseen if r not in made]
        if other:
            made.update(zip(other, self._whole(other), strict=True))
        out = b"".join([known[r] if r in known else made[r] for r in runs])
        self.runs.keep({r: ids for r, ids in made.items() if len(r) <= CACHED_CHARS})
        return out


_encoders: dict[str, RunEncoder] = {}


def encoder(path: str) -> RunEncoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = RunEncoder(path)
    return _encoders[path]


def pack_shard(doc_ids: list[int | None], parts: list[bytes], width: int) -> bytes:
    """A file of documents in the order of their ids, those without one first."""
    named = [d for d in doc_ids if d is not None]
    least = named[0] if named else 0
    ends = np.cumsum([len(p) // width for p in parts], dtype=np.int64)
    return b"".join(
        [
            HEAD.pack(MAGIC, width, len(doc_ids) - len(named), least),
            EliasFano.of(ends).to_bytes(),
            EliasFano.of([d - least for d in named]).to_bytes(),
            *parts,
        ]
    )


class TokenShard:
    """A file, read: documents by place or by id, without unpacking the others."""

    def __init__(self, data: bytes):
        magic, self.width, self.unnamed, self.least = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no token file")
        self.ends, at = EliasFano.read(data, HEAD.size)
        self.names, at = EliasFano.read(data, at)
        n = self.ends[len(self.ends) - 1] if len(self.ends) else 0
        if len(data) < at + n * self.width:
            raise ValueError("a token file shorter than declared")
        self.ids = np.frombuffer(data, f"<u{self.width}", n, at)

    def __len__(self) -> int:
        return len(self.ends)

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at a place, its end id included."""
        bounds = self.ends.select(max(place - 1, 0), place + 1)
        return self.ids[bounds[0] if place else 0 : bounds[-1]]

    def places(self, doc_id: int) -> range:
        """Where the documents of an id lie."""
        wanted = doc_id - self.least
        if wanted < 0:
            return range(0)
        return range(self.unnamed + self.names.find(wanted), self.unnamed + self.names.find(wanted + 1))

    def blocks(self, rows: int = ROWS_OUT) -> Iterator[tuple[list[int | None], np.ndarray]]:
        """Document ids and bounds (one more than documents), some documents at a time."""
        for first in range(0, len(self), rows):
            last = min(first + rows, len(self))
            begin = self.ends[first - 1] if first else 0
            names: list[int | None] = [None] * max(0, min(last, self.unnamed) - first)
            at = max(first, self.unnamed) - self.unnamed
            names += (self.names.select(at, max(at, last - self.unnamed)) + self.least).tolist()
            yield names, np.concatenate([[begin], self.ends.select(first, last)])


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    text: str = "text",
    doc_id: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Write the ids of all texts, `end_id` after each, into files in a new folder.

    `tokenizer` is the path of a tokenizers file on every executor, of a kind that drops
    white space. Texts are encoded whole, without added special tokens. Null text has
    the end id alone. Documents lie in ascending order of id, which must be a whole
    number; those without an id come first, and rows equal in id are ordered by their
    text. Repeated rows are written again. An empty table has one file without documents.
    Other columns are not read, whatever their names.

    Rows are shuffled once, by ranges of (id, text hash, row), so neither a hot id nor
    copies meet in one task, and a task holds one open file of `shard_bytes`.
    """
    schema = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("content", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        end = np.array([end_id], tool.type).tobytes()
        shard = TaskContext.get().partitionId() << SEQUENCE_BITS
        names: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            content = pack_shard(names, parts, tool.width)
            row = [shard, len(names), held // tool.width, content]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names.append(name)
                parts.append(tool.encode(value or "") + end)
                held += len(parts[-1])
                if held >= shard_bytes:
                    yield closed()
                    names, parts, held, shard = [], [], 0, shard + 1
        if names:
            yield closed()

    # a file of no documents, so that readers of an empty table find one
    spark = docs.sparkSession
    none = spark.createDataFrame([(-1, 0, 0, pack_shard([], [], 2))], "shard long, n_docs long, n_ids long, content binary")
    rows = docs.select(F.col(doc_id).cast("long").alias("name"), F.col(text).alias("body"))
    files = (
        rows.withColumns({"hash": F.xxhash64("body"), "row": F.monotonically_increasing_id()})
        .orderBy(F.col("name").asc_nulls_first(), "hash", "row")
        .select("name", "body")
        .mapInArrow(work, none.schema)
    )
    files.unionByName(none).select(F.col("content").cast("string"), "shard", "n_docs", "n_ids").write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("shard", "n_docs", "n_ids").text(path)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """How many ids lie before each file (`shard`, `_tm_start`), from folder names alone."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("shard").cast("long"), F.col("n_ids").cast("long"), F.shiftright(F.col("shard").cast("long"), SEQUENCE_BITS).alias("task")
    )
    inside = Window.partitionBy("task").orderBy("shard")
    tasks = files.groupBy("task").agg(F.sum("n_ids").alias("total"))  # one row per task that wrote
    tasks = tasks.select("task", (F.sum("total").over(Window.orderBy("task")) - F.col("total")).alias("before"))
    return files.withColumn("inside", F.sum("n_ids").over(inside) - F.col("n_ids")).join(tasks, "task").select(
        "shard", (F.col("before") + F.col("inside")).alias("_tm_start")
    )


def read_token_files(spark: SparkSession, path: str, tokens: bool = False) -> DataFrame:
    """A row per document: `doc_id`, `start`, `n_tokens`, `ids_crc32`, and `tokens` if asked.

    `start` counts the ids of all documents before it, `n_tokens` the document's with its
    end id, `ids_crc32` is over them as little-endian 32-bit numbers. Offsets come from
    the select structure of each file, a block of documents at a time.
    """
    added = "doc_id long, _tm_at long, n_tokens long, ids_crc32 long" + (", tokens array<long>" if tokens else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = TokenShard(data.as_buffer().to_pybytes())
                for names, bounds in held.blocks():
                    spans = [held.ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    columns = [
                        pa.array([shard] * len(names), pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array(bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([zlib.crc32(s.astype("<u4")) for s in spans], pa.int64()),
                    ]
                    if tokens:
                        columns.append(pa.array(spans, pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, schema_names)

    schema = f"shard long, {added}"
    schema_names = [c.strip().split(" ")[0] for c in schema.split(",")]
    files = spark.read.format("binaryFile").load(path).select(F.col("shard").cast("long").alias("shard"), "content")
    found = files.mapInArrow(work, schema).join(file_starts(spark, path), "shard")
    return found.select(
        "doc_id", (F.col("_tm_start") + F.col("_tm_at")).alias("start"), "n_tokens", "ids_crc32",
        *(["tokens"] if tokens else []),
    )
