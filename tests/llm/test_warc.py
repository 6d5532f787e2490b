"""ZIP directories, records and the round trip through packages."""

import hashlib
import io
import zipfile

import pytest

from postlytics.llm import warc_zip as wz
from postlytics.llm.queries import QUERIES, STATEMENTS
from postlytics.session import workspace
from tests.conftest import SF_DIR

PAGES = "page_id long, url string, html string"


def zip_bytes(zip64, comment=b"", compression=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", compression) as file:
        file.comment = comment
        for name, content in (("a", b"alpha"), ("dir/b", b""), ("é", b"PK\x05\x06" * 9)):
            with file.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                member.write(content)
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"note", b"PK\x05\x06" + b"x" * 40])
@pytest.mark.parametrize("shift", [0, 7])
def test_directory(zip64, comment, shift):
    data = zip_bytes(zip64, comment)
    found = {m.name: data[m.start : m.start + m.size] for m in wz.members(io.BytesIO(data), len(data))}
    assert found == {"a": b"alpha", "dir/b": b"", "é": b"PK\x05\x06" * 9}


def test_zip64_records(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = zip_bytes(True)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    found = {m.name: data[m.start : m.start + m.size] for m in wz.members(io.BytesIO(data), len(data))}
    assert found == {"a": b"alpha", "dir/b": b"", "é": b"PK\x05\x06" * 9}


@pytest.mark.parametrize("damage", [b"", b"no zip at all", zip_bytes(False)[:-30]])
def test_damaged_files_are_refused(damage):
    with pytest.raises(ValueError):
        wz.members(io.BytesIO(damage), len(damage))


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
        file.writestr("a", b"alpha" * 100)
    with pytest.raises(ValueError, match="not stored"):
        wz.members(io.BytesIO(out.getvalue()), len(out.getvalue()))


def test_damaged_payload_is_refused():
    content = wz.record(1, "http://a", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None)
    assert wz.parse_record(content)["payload_bytes"] == 200
    with pytest.raises(ValueError, match="damaged"):
        wz.parse_record(content.replace(b"xxx", b"xyx"))


def plain(pages):
    first = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        target = first.get(data) if sum((p[2] or "").encode() == data for p in pages) > 1 else None
        refers = target if target is not None and target != page_id else None
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


def test_query_equals_plain_reading(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert rows(QUERIES["op5_warc_zip"](spark, SF_DIR)) == plain(pages)
    assert "op5_warc_zip" in STATEMENTS


ODD = [
    (5, "http://a/\r\nWARC-Type: x", "é" * 60),
    (3, None, "é" * 60),
    (3, None, "é" * 60),
    (9, "http://b/", "é" * 60),
    (1, "http://c/", "short"),
    (2, "http://c/", "short"),
    (4, "http://d/", None),
    (6, "http://d/", ""),
    (7, "http://d/", "\r\n\r\nHTTP/1.1" * 99),
    (8, "http://e/", "long" * 500_000),
    (None, "http://f/", "é" * 60),
    (None, None, None),
]


def test_copies_nulls_and_long_payloads(spark):
    frame = spark.createDataFrame([(*p, "x") for p in ODD], PAGES + ", payload string")
    assert rows(wz.archive_report(frame)) == plain(ODD)
    assert wz.archive_report(frame.filter("page_id > 99")).count() == 0


def test_small_packages_and_blocks_lose_nothing(spark):
    frame = spark.createDataFrame(ODD, PAGES)
    manifest = wz.write_packages(wz.revisits(frame), workspace(spark, "small"), package_bytes=300)
    assert manifest.count() > 3
    assert rows(wz.read_packages(manifest, block_bytes=100)) == plain(ODD)
