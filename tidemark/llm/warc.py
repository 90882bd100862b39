"""Legacy ARC archives to WARC, with revisit records for repeated payloads.

An ARC file is a version block and records. A record is one header line, whose last
field declares the length, and so many bytes. Version 1 has five fields, version 2 ten.
WARC files are written by Spark's text writer: a record is a line, a gzip member of its
own. So they are committed like any Spark output, also when executors are lost, and can
lie in any store that Spark writes to. The line separator is a zero byte: the last byte
of a member, the highest of its length, is zero up to 16 MB and left to the separator;
behind a larger member the zero byte is padding, which gzip readers skip.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote_plus, unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import null_safe

ARCHIVE_BYTES = 8_000_000   # an archive is closed when it is as large
FILE_BYTES = 64_000_000     # a WARC file is closed when it is as large
BYTES_OUT = 4_000_000       # packed records that a writer hands on at once
FED = 16_384                # bytes of a file that are unpacked at once
ROWS_OUT = 500              # records that a reader hands on at once
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    "Filename Archive-length",
}
END = "\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- ARC ---------------------------------------------------------------------------

class ArcRecord(NamedTuple):
    version: int
    url: str
    ip: str
    date: str
    content_type: str
    body: bytes
    truncated: bool


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, offset: int, url: str, date: str, body: bytes) -> bytes:
    """White space and control characters of the address are percent-encoded."""
    url = re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url) or "unknown:"
    extra = f" 200 {hashlib.md5(body).hexdigest()} - {offset} {name}" if version == 2 else ""
    head = f"{url} 0.0.0.0 {date} text/html{extra} {len(body)}\n".encode("utf-8", "surrogatepass")
    return head + body + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an archive, its version blocks among them.

    The version comes from the last version block (1 before any). A record whose
    declared length exceeds what is there has the rest of the file and is marked
    truncated; a header line that the end of the file cuts short is no record. A header
    line with another number of fields raises ValueError.
    """
    version, at = 1, 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].decode("utf-8", "surrogatepass").rstrip("\r")
        fields, at = line.split(" "), end + 1
        length = int(fields[-1])
        body = data[at : at + length]
        if fields[0].startswith("filedesc://"):
            version = int(body.split(None, 1)[0])
        if len(fields) != len(ARC_FIELDS[version].split()):
            raise ValueError(f"an ARC header of version {version} with {len(fields)} fields: {line[:200]}")
        yield ArcRecord(version, fields[0], fields[1], fields[2], fields[3], body, len(body) < length)
        at += length


def pack_arc(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "20240101000000",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Pages as ARC archives of about `archive_bytes`, one per row (`archive`).

    The body of a record is an HTTP response whose header carries the page's id and
    the number of its row. Archives are of version 1 and 2 in turn. Ids of any type are
    written as strings. Null html is an empty payload, a null id is left out of the header,
    an empty table gives no archive. Rows are numbered as they come: write the archives
    once before they are read more than once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0

        def closed(parts: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])

        for batch in batches:
            parts: list[bytes] = []
            held = 0
            for row, page, where, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not parts:
                    version = made % 2 + 1
                    made += 1
                    name = f"{row}.arc"
                    parts, held = [arc_version_block(version, name, date)], 0
                number = "" if page is None else f"X-Page-Id: {quote_plus(page)}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{number}X-Row: {row}{END}"
                parts.append(arc_record(version, name, held, where or "", date, head.encode() + (payload or b"")))
                held += len(parts[-1])
                if held >= archive_bytes:
                    yield closed(parts)
                    parts = []
            if parts:
                yield closed(parts)

    return pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(page_id).cast("string").alias("page"),
        F.col(url).alias("url"),
        F.col(html).cast("binary").alias("payload"),
    ).mapInArrow(work, "archive binary")


RECORD = (
    "record_id string, record_type string, url string, ip string, date string, content_type string, "
    "page_id string, row long, http_header string, payload binary, payload_bytes long, "
    "payload_digest string, truncated boolean"
)
RECORD_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("ip", pa.string()),
        ("date", pa.string()), ("content_type", pa.string()), ("page_id", pa.string()), ("row", pa.int64()),
        ("http_header", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("truncated", pa.bool_()),
    ]
)


def iso_date(date: str) -> str:
    """ARC dates have 14 digits, early ones 12."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def header_number(header: str, name: str) -> int | None:
    found = re.search(rf"^{name}: (-?\d+)\r?$", header, re.MULTILINE)
    return int(found[1]) if found else None


def header_text(header: str, name: str) -> str | None:
    found = re.search(rf"^{name}: ([^\r\n]*)\r?$", header, re.MULTILINE)
    return unquote_plus(found[1]) if found else None


def warc_fields(r: ArcRecord) -> dict:
    """What a WARC record says in place of an ARC record.

    The id is a name-based UUID of address, date and body, so reruns agree.
    """
    header, mark, payload = r.body.partition(END.encode())
    if r.url.startswith("filedesc://"):
        kind, header, payload = "warcinfo", b"", r.body
    elif r.body.startswith(b"HTTP/") and mark:
        kind = "response"
    else:
        kind, header, payload = "resource", b"", r.body
    text = header.decode("utf-8", "replace")
    name = f"{r.url} {r.date} {hashlib.sha1(r.body).hexdigest()}"
    return {
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}", "record_type": kind, "url": r.url,
        "ip": r.ip, "date": iso_date(r.date), "content_type": r.content_type,
        "page_id": header_text(text, "X-Page-Id"), "row": header_number(text, "X-Row"),
        "http_header": text, "payload": payload, "payload_bytes": len(payload),
        "payload_digest": base32_sha1(payload), "truncated": r.truncated,
    }


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def convert_arc(archives: DataFrame, archive: str = "archive", id_type: str = "long") -> DataFrame:
    """The records of ARC archives as WARC records; a version block is a warcinfo.

    `page_id` is what the HTTP header says, as `id_type`; null without it. Null and empty
    archives, and empty tables, have no records.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield from _batches((warc_fields(r) for r in parse_arc(data or b"")), RECORD_ARROW)

    return archives.select(archive).mapInArrow(work, RECORD).withColumn("page_id", F.col("page_id").cast(id_type))


def store_archives(archives: DataFrame, path: str) -> DataFrame:
    """Write archives (one per row) into a new folder, a few per row group, and read them from there."""
    options = {"compression": "zstd", "parquet.block.size": 4 * ARCHIVE_BYTES, "parquet.block.size.row.check.min": 1}
    archives.write.options(**options).parquet(path)
    return archives.sparkSession.read.schema(archives.schema).parquet(path)


# -- revisits ----------------------------------------------------------------------

def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Of responses with equal payloads, the one with the largest page id stays.

    The others become revisits: `refers_to` is its page id, `refers_to_id` its record
    id. Payloads under `least_bytes` stay responses, and so do other record types. Equal
    page ids are told apart by row number. The first of a payload comes from an
    aggregate with a map-side half; the join on digests is an ordinary shuffled one, so
    adaptive execution splits a payload that many records share. Records without an id
    rank below those with one; records of equal id and row are told apart by nothing, so rows have
    to be numbered once (`store_archives`). An empty table gives no rows.
    """
    able = (F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes)
    first = (
        records.filter(able)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "row", "record_id")).alias("first"))
        .select("payload_digest", "payload_bytes", "first.*")
    )
    other = F.col("f.record_id").isNotNull() & ~F.col("r.row").eqNullSafe(F.col("f.row"))
    marked = (
        records.withColumn("able", able)
        .alias("r")
        .join(
            first.withColumn("able", F.lit(True)).alias("f"),
            null_safe("r", "f", [(c, c) for c in ("able", "payload_digest", "payload_bytes")]),
            "left",
        )
    )
    kept = [F.col(f"r.{c}") for c in records.columns if c not in ("record_type", "payload")]
    return marked.select(
        *kept,
        F.when(other, "revisit").otherwise(F.col("r.record_type")).alias("record_type"),
        F.when(~other, F.col("r.payload")).alias("payload"),
        F.when(other, F.col("f.page_id")).alias("refers_to"),
        F.when(other, F.col("f.record_id")).alias("refers_to_id"),
    )


# -- WARC --------------------------------------------------------------------------

def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def warc_text() -> Column:
    """A record of `mark_revisits` as WARC, without the line ends after it."""
    kind = F.col("record_type")
    payload = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    block = F.when(
        kind.isin("response", "revisit"), F.concat("http_header", F.lit(END), payload)
    ).otherwise(payload)
    revisit = kind == "revisit"
    media = (
        F.when(kind.isin("response", "revisit"), "application/http; msgtype=response")
        .when(kind == "warcinfo", "application/warc-fields")
        .otherwise(F.col("content_type"))
    )
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.col("date")),
        _line("WARC-Target-URI", F.when(kind != "warcinfo", F.col("url"))),
        _line("WARC-IP-Address", F.when(kind != "warcinfo", F.col("ip"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Truncated", F.when(F.col("truncated"), F.lit("length"))),
        _line("WARC-Profile", profile),
        _line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">"))),
        _line("X-Refers-To-Page-Id", F.url_encode(F.col("refers_to").cast("string"))),
        _line("X-Payload-Length", F.col("payload_bytes")),
        _line("Content-Type", media),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def member(record: str) -> bytes:
    """A record as a gzip member, whose last byte is left to the separator if it is zero."""
    packed = gzip.compress(record.encode() + END.encode(), 6, mtime=0)
    return packed[:-1] if packed[-1] == 0 else packed


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write records as WARC files of one gzip member per record into folders of `path`.

    A task closes a file when it has `file_bytes`, so a file is longer by one record at most.
    An empty table gives no file.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = 0, 0
        made: list[bytes] = []

        def out(rows: list[bytes], part: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array([part] * len(rows), pa.int32())], ["value", "part"]
            )

        waiting = 0
        for batch in batches:
            for record in batch.column(0):
                if held >= file_bytes:
                    if made:
                        yield out(made, part)
                    made, waiting, held, part = [], 0, 0, part + 1
                made.append(member(record.as_py()))
                waiting += len(made[-1])
                held += len(made[-1])
                if waiting >= BYTES_OUT:
                    yield out(made, part)
                    made, waiting = [], 0
        if made:
            yield out(made, part)

    packed = records.select(warc_text().alias("record")).mapInArrow(work, "value binary, part int")
    packed.select(F.col("value").cast("string"), "part").write.partitionBy("part").option("lineSep", "\0").text(path)


def inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of a file, unpacked if it is gzipped, also in several members with zero bytes between them."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at = memoryview(data), 0
    while at < len(view):
        if not view[at]:
            at += 1
            continue
        tool = zlib.decompressobj(31)
        while not tool.eof and at < len(view):
            fed = view[at : at + FED]
            piece = tool.decompress(fed, step)
            while piece or tool.unconsumed_tail:
                yield piece
                piece = tool.decompress(tool.unconsumed_tail, step)
            at += len(fed) - len(tool.unused_data)
        yield tool.flush()
        if not tool.eof:
            raise ValueError("a WARC file that ends inside a gzip member")


def parse_warc(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of records, by declared lengths.

    A file that ends inside a record raises ValueError.
    """
    buffer, ended = bytearray(), False

    def fill(n: int) -> bool:
        nonlocal ended
        while len(buffer) < n and not ended:
            piece = next(pieces, None)
            if piece is None:
                ended = True
            else:
                buffer.extend(piece)
        return len(buffer) >= n

    while True:
        while fill(2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        if not fill(1):
            return
        seen = 0
        while (at := buffer.find(END.encode(), max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                raise ValueError("a WARC header without an end")
        lines = bytes(buffer[:at]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:100]}")
        header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, length = at + 4, int(header["content-length"])
        if not fill(start + length):
            raise ValueError("a WARC record shorter than declared")
        yield header, bytes(buffer[start : start + length])
        del buffer[: start + length]


READ = (
    "record_id string, record_type string, url string, date string, page_id string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to string, refers_to_id string"
)
READ_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
        ("date", pa.string()), ("page_id", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
        ("refers_to_id", pa.string()),
    ]
)


def _read_fields(header: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = header["warc-type"]
    http, _, payload = block.partition(END.encode()) if kind in ("response", "revisit") else (b"", b"", block)
    declared = header.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        n, digest = int(header["x-payload-length"]), declared
    else:
        n, digest = len(payload), base32_sha1(payload)
        if declared and declared != digest:
            raise ValueError(f"digest of {header['warc-record-id']} is {digest}, not {declared}")
    page = header.get("x-refers-to-page-id")
    return {
        "record_id": header["warc-record-id"].strip("<>"), "record_type": kind,
        "url": header.get("warc-target-uri"), "date": header["warc-date"],
        "page_id": header_text(http.decode("utf-8", "replace"), "X-Page-Id"),
        "payload": payload if payloads and kind != "revisit" else None, "payload_bytes": n,
        "payload_digest": digest, "refers_to": None if page is None else unquote_plus(page),
        "refers_to_id": header.get("warc-refers-to", "").strip("<>") or None,
    }


def read_warc(spark: SparkSession, path: str, payloads: bool = True, id_type: str = "long") -> DataFrame:
    """The records of the WARC files in a folder and those below, digests of payloads checked.

    A file is held as a whole while its records are unpacked piece by piece. Page ids
    come back as `id_type`. A folder without a file gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = (_read_fields(h, b, payloads) for h, b in parse_warc(inflated(data)))
                yield from _batches(rows, READ_ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    ids = {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}
    return files.mapInArrow(work, READ).withColumns(ids)
