import base64
import hashlib
import io
import struct
import zipfile

import pytest

from loanlens.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string, size int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in rows], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [
    (5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, "http://b", "<p>same</p>"),
    (1, None, None), (2, "http://c", ""), (None, "http://d", "<p>alone</p>"), (None, "http://e", "<p>same</p>"),
    (7, "http://f\r\nX: y", "ünïcode 漢字\r\n\r\nWARC/1.1\r\n"), (7, "http://f", "other"), (8, "http://g", "z" * 300_000),
    (11, "http://h", "again"), (11, "http://h", "again"),
]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        size, least_id = len((h or "").encode()), first.get(h or "")
        revisit = size >= least and least_id is not None and i != least_id
        out.append((i, size, digest(h), "revisit" if revisit else "response", least_id if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip_equals_brute_force(spark, least):
    got = W.round_trip(pages_of(spark, ROWS), least)
    rows = got.collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in rows), key=str) == expected(ROWS, least)
    for r in rows:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest and len(r.payload) == r.payload_bytes
    assert {r.url for r in rows if r.page_id == 7} == {"http://f%0D%0AX: y", "http://f"}
    assert W.round_trip(pages_of(spark, []), 0).count() == 0


def test_small_archives_are_all_read(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"page {i} " * 50) for i in range(200)]
    listed = W.write_archives(pages_of(spark, rows), f"file://{tmp_path}", archive_bytes=2000)
    listed.write.parquet(f"{tmp_path}/list")
    listed = spark.read.parquet(f"{tmp_path}/list")
    assert listed.count() > 10 and listed.agg({"records": "sum"}).first()[0] == 200
    assert sorted(r.page_id for r in W.read_archives(listed).select("page_id").collect()) == list(range(200))


def test_python_reads_our_archives(tmp_path):
    out = W.ArchiveWriter(str(tmp_path / "a.wacz"))
    for i in range(3):
        out.add(W.record(i, "u", b"body", digest("body"), 4, None, False))
    assert out.close()[1] == 3
    with zipfile.ZipFile(tmp_path / "a.wacz") as z:
        assert z.testzip() is None and z.namelist() == [W.DATA, W.INDEX]
    assert [r["page_id"] for r in W.read_records(str(tmp_path / "a.wacz"))] == [0, 1, 2]


def _zip64(members):
    """A ZIP file whose sizes and offsets all stand in ZIP64 fields."""
    out, entries = io.BytesIO(), b""
    for name, data in members:
        offset = out.tell()
        wide = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        head = (45, 0, 0, 0, 0, 0, W.FULL32, W.FULL32)
        out.write(W.LOCAL + struct.pack("<HHHHHIIIHH", *head, len(name), len(wide)) + name + wide + data)
        wide = struct.pack("<HHQQQ", 1, 24, len(data), len(data), offset)
        entries += W.ENTRY + struct.pack("<HHHHHHIIIHHHHHII", 45, *head, len(name), len(wide), 0, 0, 0, 0, W.FULL32)
        entries += name + wide
    start = out.tell()
    out.write(entries)
    end = out.tell()
    out.write(W.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), len(entries), start))
    out.write(W.LOCATOR64 + struct.pack("<IQI", 0, end, 1))
    out.write(W.END + struct.pack("<HHHHIIH", 0, 0, W.FULL16, W.FULL16, W.FULL32, W.FULL32, 5) + b"PK\x05\x06!")
    return out.getvalue()


def test_zip64_directory_and_comment(tmp_path):
    path = tmp_path / "big.wacz"
    path.write_bytes(_zip64([(b"one", b"first"), (b"two", b"second member")]))
    reader = W.RangeReader(str(path))
    found = W.members(reader)
    assert {n: reader.read(m.start, m.size) for n, m in found.items()} == {"one": b"first", "two": b"second member"}


@pytest.mark.parametrize("damage", ["deflated", "no_end", "cut_directory", "wrong_payload"])
def test_damage_raises(tmp_path, damage):
    path = tmp_path / "x.wacz"
    if damage == "deflated":
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(W.DATA, "x" * 1000)
    elif damage == "no_end":
        path.write_bytes(b"no archive at all")
    elif damage == "cut_directory":
        data = bytearray(_zip64([(b"one", b"first")]))
        data[data.index(W.ENTRY)] = 0
        path.write_bytes(bytes(data))
    else:
        out = W.ArchiveWriter(str(path))
        out.add(W.record(1, "u", b"body", digest("other"), 4, None, False))
        out.close()
    with pytest.raises(ValueError):
        list(W.read_records(str(path)))
