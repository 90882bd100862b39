import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.queries import op4_warc

RECORDS = [
    (1, "http://a.example/1", b"one"), (2, "http://a.example/x y", b"two\r\n\r\nWARC/1.1\r\n"), (3, "", b""),
]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = warc.arc_version_block(version, "f.arc", "20240101000000")
    for i, url, body in RECORDS:
        data += warc.arc_record(version, "f.arc", len(data), url, "199912312359", body)
    block, *found = warc.parse_arc(data)
    assert block.url == "filedesc://f.arc" and block.version == version
    assert [r.body for r in found] == [b for *_, b in RECORDS] and not any(r.truncated for r in found)
    assert found[1].url == "http://a.example/x%20y" and found[2].url == "unknown:"
    assert warc.warc_fields(found[0])["date"] == "1999-12-31T23:59:00Z"
    assert warc.warc_fields(block)["record_type"] == "warcinfo"
    cut = list(warc.parse_arc(data[:-30]))
    assert cut[-1].truncated or len(cut) < 4
    with pytest.raises(ValueError, match="fields"):
        list(warc.parse_arc(data + b"http://a.example/ 0.0.0.0 text/html 3\nabc\n"))
    assert list(warc.parse_arc(b"")) == []


def test_records_made_of_pieces():
    text = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    data = text * 3
    for step in (1, 2, 7, 1000):
        found = list(warc.parse_warc(data[i : i + step] for i in range(0, len(data), step)))
        assert [b for _, b in found] == [b"a\r\n\r\n"] * 3
    with pytest.raises(ValueError, match="shorter"):
        list(warc.parse_warc(iter([text[:-8]])))
    with pytest.raises(ValueError, match="no WARC"):
        list(warc.parse_warc(iter([b"HTTP/1.1 200\r\n\r\n"])))


def expected(rows):
    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    top = {}
    for page, _, text in rows:
        b = (text or "").encode()
        top[b] = max(top.get(b, -1), -1 if page is None else page)
    out = []
    for page, _, text in rows:
        b = (text or "").encode()
        first = page is not None and page == top[b]
        out.append((page, len(b), digest(b), "response" if first else "revisit", None if first else top[b]))
    return sorted(out, key=repr)


def test_query(spark, small):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    got = sorted((tuple(r) for r in op4_warc(spark, small).collect()), key=repr)
    assert got == expected(rows)


def test_copies_nulls_and_odd_payloads(spark, frame, tmp_path):
    rows = [
        (1, "http://a/", "same é"), (5, "http://b/", "same é"), (3, None, "same é"), (2, "http://c/", None), (4, "x", ""),
        (6, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "n", "alone with no id"), (7, "v", "y" * 300_000),
    ]
    pages = frame(rows, "page_id long, url string, html string")
    archives = warc.pack_arc(pages, archive_bytes=200)
    warc.write_warc(warc.mark_revisits(warc.convert_arc(archives)), f"{tmp_path}/w", file_bytes=300)
    back = warc.read_warc(spark, f"{tmp_path}/w").filter("record_type <> 'warcinfo'").collect()
    got = {r.page_id: r for r in back}
    assert len(back) == len(rows)
    assert (got[1].record_type, got[1].refers_to, got[3].refers_to, got[5].record_type) == ("revisit", 5, 5, "response")
    assert (got[2].record_type, got[2].refers_to, got[4].payload_bytes) == ("revisit", 4, 0)
    assert got[None].record_type == "response" and got[7].payload_bytes == 300_000
    for page, _, text in rows:
        if got[page].record_type == "response":
            assert bytes(got[page].payload).decode() == (text or "")
    assert got[1].refers_to_id == got[5].record_id


def members(data):
    """Each gzip member of a file alone."""
    out = []
    while data := data.lstrip(b"\0"):
        tool = zlib.decompressobj(31)
        out.append(tool.decompress(data) + tool.flush())
        data = tool.unused_data
    return out


def test_a_member_per_record_and_files_by_bytes(spark, frame, tmp_path):
    rows = [(i, f"http://a/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 30) for i in range(60)]
    pages = frame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(warc.mark_revisits(warc.convert_arc(warc.pack_arc(pages))), f"{tmp_path}/w", file_bytes=2_000)
    files = [p.read_bytes() for p in Path(f"{tmp_path}/w").rglob("part-*")]
    assert len(files) > 5 and all(len(f) < 2_000 + 1_000 for f in files)
    found = [m for f in files for m in members(f)]
    assert len(found) == 61 and all(len(list(warc.parse_warc(iter([m])))) == 1 for m in found)
    assert sorted(b"".join(map(gzip.decompress, files))) == sorted(b"".join(found))


def test_members_beyond_16_mb_and_cut_files():
    record = "WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {}\r\n\r\n{}"
    texts = ["a" * 17_000_000, "b", "c" * 16_777_300]
    data = b"".join(warc.member(record.format(len(t), t)) + b"\0" for t in texts)
    assert [b.decode() for _, b in warc.parse_warc(warc.inflated(data))] == texts
    assert gzip.decompress(data).count(b"WARC/1.1") == 3
    for cut in (100, 2):
        with pytest.raises(ValueError, match="inside a gzip member"):
            list(warc.parse_warc(warc.inflated(data[:-cut])))


def test_ids_of_any_type_in_any_order(spark, frame, tmp_path):
    odd = ["b/é \r\nX-Row: 7", "b", "", "a+%20", None, "10", "9"]
    rows = [(i, "u", "same" if k % 2 else f"text {k}") for k, i in enumerate(odd)]
    pages = frame(rows, "page_id string, url string, html string").repartition(4).orderBy(F.rand())
    archives = warc.store_archives(warc.pack_arc(pages), f"{tmp_path}/a")
    records = warc.mark_revisits(warc.convert_arc(archives, id_type="string"))
    warc.write_warc(records, f"{tmp_path}/w")
    back = warc.read_warc(spark, f"{tmp_path}/w", id_type="string").filter("record_type <> 'warcinfo'").collect()
    assert sorted(map(repr, (r.page_id for r in back))) == sorted(map(repr, odd))
    assert {r.page_id: r.refers_to for r in back if r.record_type == "revisit"} == {"a+%20": "b", "10": "b"}
    assert {r.page_id: bytes(r.payload).decode() for r in back if r.payload} == {
        i: t for i, _, t in rows if i not in ("a+%20", "10")
    }


def test_equal_ids_small_payloads_and_empty_table(spark, frame):
    rows = [(1, "u", "aa"), (1, "u", "aa"), (2, "u", "b" * 9), (3, "u", "b" * 9)]
    pages = frame(rows, "page_id long, url string, html string")
    records = warc.convert_arc(warc.pack_arc(pages)).filter("record_type = 'response'")
    kinds = sorted((r.page_id, r.record_type) for r in warc.mark_revisits(records).collect())
    assert kinds == [(1, "response"), (1, "revisit"), (2, "revisit"), (3, "response")]
    kinds = sorted((r.page_id, r.record_type) for r in warc.mark_revisits(records, least_bytes=3).collect())
    assert kinds == [(1, "response"), (1, "response"), (2, "revisit"), (3, "response")]
    assert warc.mark_revisits(warc.convert_arc(warc.pack_arc(pages.limit(0)))).count() == 0
