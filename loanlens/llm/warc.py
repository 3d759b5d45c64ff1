"""Web archives packed in ZIP files: written per task, read by ranges.

An archive is a ZIP file of stored (uncompressed) members: one WARC file whose
records are gzip members of their own, and an index with the place of every
record.  The reader takes the ZIP's directory from its end, finds where the
members lie, reads the index, and then reads single records by range; nothing
is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import shared_folder, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
ROW = "urn:x-page:"

# Fixed values of the ZIP format.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"file:/[^/]", path):
        path = path.replace("file:", "file://", 1)
    return pafs.FileSystem.from_uri(path)


class Member(NamedTuple):
    name: str
    start: int  # of the stored bytes in the archive
    size: int


class RangeReader:
    """Byte ranges of one file."""

    def __init__(self, path: str):
        fs, inner = filesystem(path)
        self._file = fs.open_input_file(inner)
        self.size = self._file.size()

    def read(self, start: int, size: int) -> bytes:
        if start < 0 or size < 0 or start + size > self.size:
            raise ValueError(f"range {start}+{size} is outside the file of {self.size} bytes")
        return self._file.read_at(size, start)

    def close(self) -> None:
        self._file.close()


def _directory(reader: RangeReader) -> tuple[int, int, int]:
    """(number of entries, start, size) of the central directory."""
    tail_size = min(reader.size, 22 + FULL16)
    tail = reader.read(reader.size - tail_size, tail_size)
    at = tail.rfind(END)
    while at >= 0:  # the end record's comment must reach the end of the file
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    entries, size, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == entries or FULL32 in (size, start):
        place = reader.size - tail_size + at - 20
        locator = reader.read(place, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("ZIP64 sizes without a ZIP64 locator")
        record = reader.read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        entries, size, start = struct.unpack_from("<QQQ", record, 32)
    return entries, start, size


def members(reader: RangeReader) -> dict[str, Member]:
    """Stored members by name, from the central directory and the local headers."""
    entries, start, size = _directory(reader)
    data, at, found = reader.read(start, size), 0, {}
    for _ in range(entries):
        if data[at : at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        offset = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + n_name].decode()
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        # the ZIP64 field holds, in this order, those values that are full above
        wide, x = [], 0
        while x + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, x)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, x + 4))
            x += 4 + length
        if plain == FULL32:
            plain = wide.pop(0)
        if packed == FULL32:
            packed = wide.pop(0)
        if offset == FULL32:
            offset = wide.pop(0)
        if method != 0 or packed != plain:
            raise ValueError(f"member {name} is not stored")
        local = reader.read(offset, 30)
        if local[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        found[name] = Member(name, offset + 30 + n_name + n_extra, plain)
    return found


def _line(text: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, revisit: bool) -> bytes:
    """One WARC record, gzip-compressed; a revisit keeps the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    own = f"urn:uuid:{uuid.uuid4()}" if page_id is None else f"{ROW}{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{own}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <{ROW}{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 1, mtime=0)


class ArchiveWriter:
    """One archive file; records go straight to the store, the index follows them."""

    def __init__(self, path: str):
        fs, inner = filesystem(path)
        fs.create_dir(inner.rpartition("/")[0], recursive=True)
        self.path, self._out = path, fs.open_output_stream(inner)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(DATA, "w", force_zip64=True)
        self._index: list[str] = []
        self.bytes = 0

    def add(self, packed: bytes) -> None:
        self._data.write(packed)
        self._index.append(json.dumps({"offset": self.bytes, "length": len(packed)}))
        self.bytes += len(packed)

    def close(self) -> tuple[str, int, int]:
        self._data.close()
        with self._zip.open(INDEX, "w") as index:
            index.write("".join(f"{x}\n" for x in self._index).encode())
        self._zip.close()
        self._out.close()
        return self.path, len(self._index), self.bytes


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as (page_id, url, payload, size, sha1, refers_to, revisit).

    Of equal payloads of at least ``least_bytes`` bytes the smallest page_id is
    the response; other rows with that page_id are responses too.  The smallest
    page is found by aggregation and joined back, which adaptive execution can
    split where many pages share one payload.
    """
    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = given.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"))
    firsts = (
        rows.where(F.col("size") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"))
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "sha1", "left").select(
        "page_id", "url", "payload", "size", "sha1", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one record per page; returns the list (path, records, bytes) of the archives.

    A task starts a new file after ``archive_bytes``.  File names are new for
    each attempt, and only files of attempts that succeeded are on the list.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in names]):
                page_id, url, payload, size, sha1, refers_to, revisit = row
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                out = out or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                out.add(record(page_id, url, payload, digest, size, refers_to, revisit))
                if out.bytes >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    names = ["page_id", "url", "payload", "size", "sha1", "refers_to", "revisit"]
    rows = with_roles(pages, least_bytes).select(*names)
    return rows.mapInArrow(run, "path string, records long, bytes long")


def parse_record(packed: bytes) -> dict:
    """Headers and payload of one gzip-compressed record."""
    whole = gzip.decompress(packed)
    head, _, rest = whole.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    page = re.search(f"<{ROW}(.*)>", headers["warc-record-id"])
    refers = re.search(f"<{ROW}(.*)>", headers.get("warc-refers-to", ""))
    kind = headers["warc-type"]
    digest = headers["warc-payload-digest"].partition(":")[2]
    whole_payload = kind == "response"
    if whole_payload and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError("the payload does not have its digest")
    return {
        "page_id": int(page[1]) if page else None,
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "payload": payload if whole_payload else None,
        "payload_bytes": len(payload) if whole_payload else int(sizes[1]),
        "payload_digest": digest,
        "refers_to": int(refers[1]) if refers else None,
    }


def read_records(path: str) -> Iterator[dict]:
    """All records of an archive, each read by its own range."""
    reader = RangeReader(path)
    try:
        found = members(reader)
        data, index = found[DATA], found[INDEX]
        for line in reader.read(index.start, index.size).splitlines():
            place = json.loads(line)
            if place["offset"] + place["length"] > data.size:
                raise ValueError("the index points outside its member")
            yield parse_record(reader.read(data.start + place["offset"], place["length"]))
    finally:
        reader.close()


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ]
)


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the archives whose ``path`` is listed, one archive at a time in a task.

    A response's payload is checked against its digest; a revisit has none, and
    takes its size from the HTTP headers it kept.  ``payload`` false leaves the
    payloads out of the result.
    """
    schema = pa.schema([f for f in _RECORD if payload or f.name != "payload"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for row in read_records(path):
                    held.append({k: row[k] for k in schema.names})
                    size += len(row["payload"] or b"") if payload else 100
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {"int64": "long", "string": "string", "binary": "binary"}
    return archives.select("path").mapInArrow(run, ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in schema))


def round_trip(pages: DataFrame, least_bytes: int = 0, payload: bool = True) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads all records back.

    A null html is an empty payload; a null page_id or url has no header and
    comes back null.  Of equal payloads the smallest page_id counts, and without
    any page_id all are responses.  Repeated rows each get a record.  Line ends
    in a url are percent-encoded.  An empty table gives no archive and no rows.
    """
    folder = shared_folder(pages.sparkSession)
    archives = stored(write_archives(pages, f"{folder}/archives", least_bytes), "archive_list")
    # one archive to a task, so that reading spreads as writing did
    return read_archives(archives.repartition(max(1, archives.count())), payload)
