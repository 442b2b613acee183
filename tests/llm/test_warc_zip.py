from __future__ import annotations

import base64
import hashlib
import io
import zipfile

import pytest

from tallymark.llm import warc_zip

from tests.llm.samples import frame

PAGES = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/", "<p>same</p>"),
    (3, "http://b/", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (1, "http://e/\r\nInjected: yes", None),
    (2, "http://f/ü ñ", ""),
    (4, "http://g/", "é" * 70_000 + "\r\n\r\nWARC/1.1"),
    (6, "http://h/", "alone"),
    (6, "http://h/", "alone"),
    (None, "http://i/", "<p>same</p>"),
    (None, "http://j/", "no id"),
    (None, "http://k/", "no id"),
]


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        revisit = len(data) >= least and first is not None and first != page_id
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "ARCHIVE_BYTES", 2_000)
    for least in (0, 8):
        folder = warc_zip.write_archives(frame(spark, ROWS, PAGES), least=least)
        got = warc_zip.read_archives(spark, folder, payloads=True).collect()
        assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(ROWS, least)
        payloads = {(r.page_id, bytes(r.payload)) for r in got if r.payload is not None}
        assert payloads <= {(i, (h or "").encode()) for i, _, h in ROWS}


def test_no_pages(spark):
    folder = warc_zip.write_archives(frame(spark, [], PAGES))
    assert warc_zip.read_archives(spark, folder).count() == 0


class Bytes:
    def __init__(self, data):
        self._data, self.read_bytes = data, 0

    def size(self):
        return len(self._data)

    def read_at(self, length, place):
        self.read_bytes += length
        return self._data[place : place + length]


MEMBERS = [("archive/data.warc", b"0123456789" * 100_000), ("indexes/index.cdxj", b"{}\n"), ("ünï", b"")]


def read_all(package):
    return {name: package.read(*package.locate(name)) for name in package.members}


def test_zip64_directory():
    data = warc_zip.zip_stored(MEMBERS)
    with zipfile.ZipFile(io.BytesIO(data)) as standard:
        assert standard.testzip() is None
        assert {n: standard.read(n) for n in standard.namelist()} == dict(MEMBERS)
    assert read_all(warc_zip.StoredZip(Bytes(data))) == dict(MEMBERS)


def test_only_ranges_are_read():
    source = Bytes(warc_zip.zip_stored(MEMBERS))
    package = warc_zip.StoredZip(source)
    begin, _ = package.locate("archive/data.warc")
    assert package.read(begin + 12, 5) == b"23456"
    assert source.read_bytes < 70_000


def test_other_writers_archives():
    for comment in (b"", b"a comment with PK\x05\x06 in it"):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as standard:
            standard.comment = comment
            for name, data in MEMBERS:
                with standard.open(name, "w", force_zip64=len(data) > 100) as member:
                    member.write(data)
        assert read_all(warc_zip.StoredZip(Bytes(out.getvalue()))) == dict(MEMBERS)


def test_errors():
    with pytest.raises(ValueError):
        warc_zip.StoredZip(Bytes(b"no archive"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as standard:
        standard.writestr("packed", "x" * 1000)
    with pytest.raises(ValueError):
        warc_zip.StoredZip(Bytes(out.getvalue())).locate("packed")
    whole = warc_zip.record(1, "http://a/", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None)
    warc_zip.parse(whole)
    with pytest.raises(ValueError):
        warc_zip.parse(whole.replace(b"payload\r\n", b"pAyload\r\n"))
