"""WARC records in ZIP-packaged archives, and a reader that fetches them without unpacking.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc``, and ``indexes/index.cdxj`` with one line
of JSON per record: its place in the WARC member, length, type and digest. The writer always adds ZIP64 directory records.
The reader finds the end of the central directory from the file's tail, follows the ZIP64 locator where there is one, reads
the directory, finds where the stored bytes of both members begin, and reads each record by its range.

A record holds an HTTP response. Of records with equal payloads of at least ``least`` bytes the one with the smallest id is
the ``response``; the others are ``revisit`` records, with the response's headers (their Content-Length is the payload's)
and no payload. Smaller payloads are all responses. A null payload counts as empty. Rows that repeat an id and its payload
repeat its record; a null id can't be referred to, so that equal payloads with only null ids are all responses. Line breaks
and other control characters in a URL are percent-encoded; a null URL is left out. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import materialize, shared_folder
from tallymark.llm.files import Writing, reading

WARC, INDEX = "archive/data.warc", "indexes/index.cdxj"
# An archive is closed after the record with which it has so many bytes.
ARCHIVE_BYTES = 32 << 20
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: ZIP records by signature and fields, as in the format's specification.
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR = b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def zip_stored(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members, with sizes and places in ZIP64 fields."""
    out, directory, at = [], [], 0
    for name, data in members:
        label, crc = name.encode(), zlib.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        local = _LOCAL + struct.pack("<5H3I2H", 45, 0x800, 0, 0, 0x21, crc, _FULL32, _FULL32, len(label), len(extra))
        out += [local, label, extra, data]
        more = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        directory.append(
            _CENTRAL
            + struct.pack("<6H3I5H2I", 45, 45, 0x800, 0, 0, 0x21, crc, _FULL32, _FULL32, len(label), len(more), 0, 0, 0, 0, _FULL32)
            + label
            + more
        )
        at += len(local) + len(label) + len(extra) + len(data)
    listed = b"".join(directory)
    n = len(members)
    end64 = _END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(listed), at)
    locator = _LOCATOR + struct.pack("<IQI", 0, at + len(listed), 1)
    end = _END + struct.pack("<4H2IH", 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0)
    return b"".join([*out, listed, end64, locator, end])


class StoredZip:
    """Members of a ZIP file, read by range. ``source`` has ``size()`` and ``read_at(bytes, place)``."""

    def __init__(self, source):
        self._source = source
        self.members = {name: entry for name, entry in self._directory()}

    def _directory(self) -> Iterator[tuple[str, tuple[int, int, int]]]:
        size = self._source.size()
        tail_at = max(0, size - 22 - _FULL16)
        tail = self._source.read_at(size - tail_at, tail_at)
        at = tail.rfind(_END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP file")
        count, length, place = struct.unpack_from("<HII", tail, at + 10)
        if count == _FULL16 or length == _FULL32 or place == _FULL32:
            near = self._source.read_at(20, tail_at + at - 20)
            if near[:4] != _LOCATOR:
                raise ValueError("no ZIP64 locator")
            record = self._source.read_at(56, struct.unpack_from("<Q", near, 8)[0])
            if record[:4] != _END64:
                raise ValueError("no ZIP64 end of a central directory")
            count, length, place = struct.unpack_from("<QQQ", record, 32)
        listed, at = self._source.read_at(length, place), 0
        for _ in range(count):
            if listed[at : at + 4] != _CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", listed, at + 8)
            packed, full, n, extra, comment = struct.unpack_from("<IIHHH", listed, at + 20)
            (where,) = struct.unpack_from("<I", listed, at + 42)
            name = listed[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            fields, end = at + 46 + n, at + 46 + n + extra
            while fields + 4 <= end:
                kind, width = struct.unpack_from("<HH", listed, fields)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{width // 8}Q", listed, fields + 4))
                    full = next(wide) if full == _FULL32 else full
                    packed = next(wide) if packed == _FULL32 else packed
                    where = next(wide) if where == _FULL32 else where
                fields += 4 + width
            yield name, (method, where, packed)
            at = end + comment

    def locate(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many there are."""
        method, where, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self._source.read_at(30, where)
        if head[:4] != _LOCAL:
            raise ValueError(f"{name} has no local header")
        return where + 30 + sum(struct.unpack_from("<HH", head, 26)), size

    def read(self, begin: int, length: int) -> bytes:
        return self._source.read_at(length, begin)


class _File:
    """A pyarrow file with the two calls that ``StoredZip`` needs."""

    def __init__(self, uri: str):
        self._file = reading(uri)

    def size(self) -> int:
        return self._file.size()

    def read_at(self, length: int, place: int) -> bytes:
        return self._file.read_at(length, place)

    def close(self) -> None:
        self._file.close()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the response to ``refers_to``."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {_DATE}",
        *([] if url is None else [f"WARC-Target-URI: {quote(url, safe=_URL)}"]),
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"] if revisit else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Left as they are in a URL: all printable ASCII characters.
_URL = "".join(map(chr, range(0x21, 0x7F)))


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode().split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _id(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; the declared lengths and the digest are checked."""
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    split = data.index(b"\r\n\r\n")
    headers = _headers(data[:split])
    block = data[split + 4 : split + 4 + int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError("a record is cut off")
    split = block.index(b"\r\n\r\n")
    http, payload = _headers(block[:split]), block[split + 4 :]
    if headers["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if len(payload) != int(http["content-length"]) or f"sha1:{found}" != headers["warc-payload-digest"]:
            raise ValueError("a payload differs from its digest or length")
    return headers, http, payload


def _ready(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """page_id, url, payload and refers_to of every row."""
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    firsts = rows.filter(large).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Written, and without payloads that occur once: a payload of a third of all rows is then split in the join.
    copied = materialize(firsts.filter("n > 1").select("sha", "first"))
    met = rows.join(copied, "sha", "left")
    other = large & ~F.col("first").eqNullSafe(F.col("page_id"))
    return met.select("page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> str:
    """Write a record per row into archives of bounded size; returns their folder."""
    folder = folder or shared_folder(pages.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        lines: list[str] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal files
            name = f"pages-{part:05d}-{files:05d}.zip"
            out = Writing(f"{folder}/{name}")
            out.write(zip_stored([(WARC, b"".join(held)), (INDEX, "".join(lines).encode())]))
            out.finish()
            files += 1
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(lines)], pa.int64())], ["archive", "records"])
            held.clear()
            lines.clear()
            return row

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))
            for page_id, target, data, refers_to in zip(*columns):
                data = data.as_py()
                digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
                whole = record(page_id.as_py(), target.as_py(), data, digest, refers_to.as_py())
                lines.append(json.dumps({"offset": size, "length": len(whole), "digest": f"sha1:{digest}"}) + "\n")
                held.append(whole)
                size += len(whole)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    ready = _ready(pages, key, url, payload, least)
    ready.mapInArrow(write, "archive string, records long").write.parquet(f"{folder}/manifest")
    return folder


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record in the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    With ``payloads`` also the ``payload`` of responses, null for revisits.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                file = _File(f"{folder}/{name}")
                package = StoredZip(file)
                begin, _ = package.locate(WARC)
                entries = package.read(*package.locate(INDEX)).decode().splitlines()
                for start in range(0, len(entries), 256):
                    rows = []
                    for entry in map(json.loads, entries[start : start + 256]):
                        headers, http, payload = parse(package.read(begin + entry["offset"], entry["length"]))
                        if headers["warc-payload-digest"] != entry["digest"]:
                            raise ValueError("the index points to another record")
                        kind = headers["warc-type"]
                        rows.append(
                            (
                                _id(headers["warc-record-id"]),
                                int(http["content-length"]),
                                headers["warc-payload-digest"].removeprefix("sha1:"),
                                kind,
                                _id(headers["warc-refers-to"]) if kind == "revisit" else None,
                                payload if payloads and kind == "response" else None,
                            )
                        )
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                file.close()

    schema = _RECORDS + (", payload binary" if payloads else "")
    names = [field.split()[0] for field in schema.split(", ")]
    archives = spark.read.parquet(f"{folder}/manifest").select("archive")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(partitions, "archive").mapInArrow(read, schema)
