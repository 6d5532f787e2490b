"""WARC records in ZIP packages, written by tasks and read back by ranges.

A package is a ZIP file with two stored members: `archive/data.warc.gz`, where every record is a
gzip stream of its own, and `indexes/index.cdxj`, one line per record with its place. The reader
parses the end of the file, the ZIP64 records if there are any, and the central directory, finds
where the stored bytes of both members begin, reads the index, and then each record by its range.
No member is extracted.

Packages are rotated by size, so neither a task nor an index grows with the input. A task writes
under a name of its own and reports it; only reported files are read, so a task that runs twice
leaves a file that nobody reads. Files are opened with pyarrow's file systems, by the scheme of the
shared folder.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices, saved
from postlytics.session import workspace

# Names in a package, signatures and marks of the ZIP format.
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
END_MARK, END64_MARK, LOCATOR_MARK = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY_MARK, LOCAL_MARK = b"PK\x01\x02", b"PK\x03\x04"
FULL_32, FULL_16, ZIP64_FIELD = 0xFFFFFFFF, 0xFFFF, 0x0001
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

# smaller payloads are not worth a revisit
MIN_REVISIT_BYTES = 100
PACKAGE_BYTES = 16 << 20
BLOCK_BYTES = 4 << 20


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to) per row of `pages`.

    Of rows with equal payloads of min_bytes or more, the smallest page_id is kept and all rows of
    other ids refer to it. Null html is an empty payload. A null page_id refers like any other but
    is never referred to.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(other, F.col("first_id")).alias("refers_to")
    )


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: the response, or a revisit that keeps only the response's HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def package(records: list[tuple[int | None, bytes]], zip64: bool = False) -> bytes:
    """The bytes of a package with the given records (page_id, record)."""
    data, index = io.BytesIO(), []
    for page_id, content in records:
        packed = gzip.compress(content, compresslevel=1, mtime=0)
        index.append(json.dumps({"page": page_id, "offset": data.tell(), "length": len(packed)}))
        data.write(packed)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as file:
        for name, content in (
            (DATA, data.getbuffer()),
            (INDEX, "\n".join(index).encode()),
            (PACKAGE, json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}).encode()),
        ):
            with file.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                member.write(content)
    return out.getvalue()


MANIFEST = "path string, records long, bytes long"


def write_packages(rows: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write the rows of `revisits` as packages into a shared folder; (path, records, bytes) of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        pending: list[tuple[int | None, bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            content = package(pending)
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(content)
            return pa.RecordBatch.from_pydict({
                "path": [f"{folder}/{name}"], "records": [len(pending)], "bytes": [len(content)],
            })

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    content = record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"])
                    pending.append((row["page_id"], content))
                    held += len(content)
                    if held >= package_bytes:
                        yield flush()
                        pending, held = [], 0
        if pending:
            yield flush()

    columns = ("page_id", "url", "payload", "payload_digest", "refers_to")
    return saved(rows.select(*columns).mapInArrow(write, MANIFEST), "wacz-manifest")


@dataclass(frozen=True)
class Member:
    name: str
    start: int
    size: int


def members(file, size: int) -> list[Member]:
    """Stored members of a ZIP file, by its central directory; `file` needs seek and read.

    `start` is the first byte of a member's content. Compressed members are refused.
    """

    def part(at: int, length: int) -> bytes:
        file.seek(at)
        content = file.read(length)
        if len(content) < length:
            raise ValueError("the ZIP file is cut off")
        return content

    tail_at = max(0, size - 22 - FULL_16)
    tail = part(tail_at, size - tail_at)
    end = tail.rfind(END_MARK)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END_MARK, 0, end)
    if end < 0:
        raise ValueError("not a ZIP file: no end record")
    count, length, at = struct.unpack_from("<HII", tail, end + 10)
    if (FULL_16 == count or FULL_32 in (length, at)) and tail_at + end >= 20:
        locator = part(tail_at + end - 20, 20)
        if locator[:4] == LOCATOR_MARK:
            end64 = part(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != END64_MARK:
                raise ValueError("the ZIP64 end record is missing")
            count, length, at = struct.unpack_from("<QQQ", end64, 32)
    directory = part(at, length)
    found, cursor = [], 0
    for _ in range(count):
        if directory[cursor : cursor + 4] != ENTRY_MARK:
            raise ValueError("the central directory is damaged")
        method = struct.unpack_from("<H", directory, cursor + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, cursor + 20)
        local = struct.unpack_from("<I", directory, cursor + 42)[0]
        name = directory[cursor + 46 : cursor + 46 + n_name].decode()
        extra = directory[cursor + 46 + n_name : cursor + 46 + n_name + n_extra]
        plain, packed, local = _wide(extra, plain, packed, local)
        if method != 0 or plain != packed:
            raise ValueError(f"member is not stored: {name}")
        header = part(local, 30)
        if header[:4] != LOCAL_MARK:
            raise ValueError(f"no local header: {name}")
        found.append(Member(name, local + 30 + sum(struct.unpack_from("<HH", header, 26)), plain))
        cursor += 46 + n_name + n_extra + n_comment
    return found


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values whose 32 bits are full replaced, in order, by those of the ZIP64 field."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            wide = extra[at + 4 : at + 4 + length]
        at += 4 + length
    out = []
    for value in values:
        if value == FULL_32 and len(wide) >= 8:
            value, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
        out.append(value)
    return out


def index_blocks(path: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, int]]]:
    """Places (offset in the file, length) of a package's records, in blocks of neighbours."""
    system, name = file_system(path)
    with system.open_input_file(name) as file:
        parts = {member.name: member for member in members(file, file.size())}
        file.seek(parts[INDEX].start)
        lines = file.read(parts[INDEX].size).splitlines()
    block, held = [], 0
    for line in lines:
        place = json.loads(line)
        if place["offset"] + place["length"] > parts[DATA].size:
            raise ValueError("a record lies outside its member")
        block.append((parts[DATA].start + place["offset"], place["length"]))
        held += place["length"]
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def parse_record(content: bytes) -> dict:
    """The fields of a record; the payload of a response is measured and its digest verified."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]), "payload_bytes": stated, "payload_digest": digest,
        "record_type": kind, "refers_to": None if refers is None else _page_of(refers),
    }


RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])
RECORD_COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
BLOCKS = "path string, block long, offsets array<long>, lengths array<long>"


def read_packages(manifest: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per record of the listed packages.

    Indexes are read first, a package by a task; then blocks of records are dealt to tasks, whose
    number follows the bytes to read.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                for number, block in enumerate(index_blocks(path, block_bytes)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path]), pa.array([number], pa.int64()),
                            pa.array([[at for at, _ in block]], pa.list_(pa.int64())),
                            pa.array([[length for _, length in block]], pa.list_(pa.int64())),
                        ],
                        ["path", "block", "offsets", "lengths"],
                    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in in_slices(pa.StructArray.from_arrays(batch.columns, batch.schema.names), 1):
                system, name = file_system(values[0]["path"])
                with system.open_input_file(name) as file:
                    rows = []
                    for at, length in zip(values[0]["offsets"], values[0]["lengths"]):
                        file.seek(at)
                        rows.append(parse_record(gzip.decompress(file.read(length))))
                yield pa.RecordBatch.from_pylist(rows, RECORDS)

    total = manifest.agg(F.count(F.lit(1)), F.sum(F.ceil(F.col("bytes") / block_bytes))).first()
    listed = manifest.select("path").repartition(max(1, total[0]), "path").mapInArrow(blocks, BLOCKS)
    return listed.repartition(max(1, total[1] or 0), "path", "block").mapInArrow(read, RECORD_COLUMNS)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write a record per row of `pages` into packages and read all of them back, a row each."""
    folder = workspace(pages.sparkSession, "wacz")
    return read_packages(write_packages(revisits(pages), folder))
