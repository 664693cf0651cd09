"""Web archives in ZIP packages: written record by record, read by ranges without extraction.

A package holds ``archive/data.warc.gz``, one gzip member a record, and ``indexes/index.cdxj``, both stored,
not compressed. So a record is a range of the package itself: the central directory, or its ZIP64 form,
tells where the stored members begin, the index tells where in them the records are, and tasks read
runs of records of a few megabytes each.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from fieldbook.llm.tables import Scratch, partitions

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST_REVISIT = 1000
RUN_BYTES = 4 << 20
PACKAGE_BYTES = 256 << 20
# Fixed values of the formats.
WARC_DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_OF_DIRECTORY, ZIP64_LOCATOR, ZIP64_END = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
DIRECTORY_ENTRY, LOCAL_HEADER = b"PK\x01\x02", b"PK\x03\x04"
ZIP64_EXTRA, STORED = 1, 0
FULL_16, FULL_32 = 0xFFFF, 0xFFFFFFFF


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if path.startswith("file:") else path)


class _Sink:
    """A stream that can only be appended to, as object stores have them."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def record(row: dict) -> bytes:
    """A WARC record; a revisit has the HTTP head of its response but no payload."""
    revisit = row["record_type"] == "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(row['payload'])}\r\n\r\n".encode()
    block = head if revisit else head + row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    url = "" if row["url"] is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<urn:page:{'' if row['page_id'] is None else row['page_id']}>"),
        *([("WARC-Target-URI", url)] if url else []), ("WARC-Date", WARC_DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"), ("WARC-Profile", PROFILE)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(rows: DataFrame, folder: str, most: int = PACKAGE_BYTES) -> DataFrame:
    """Writes packages into ``folder``; returns ``path``, ``size`` and ``records`` of each.

    A repeated task writes packages of new names, and only those of the attempt that ended are listed.
    """
    def package(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = _rows(batches)
        row = next(rest, None)
        system, base = place(folder)
        while row is not None:
            name = f"{uuid.uuid4().hex}.wacz"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(f"{base}/{name}") as stream:
                sink, index, at = _Sink(stream), [], 0
                with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as zipped:
                    with zipped.open(ARCHIVE, "w", force_zip64=True) as member:
                        while row is not None and at < most:
                            packed = _gzip(record(row))
                            member.write(packed)
                            index.append(json.dumps({"id": row["page_id"], "offset": at, "length": len(packed)}))
                            at += len(packed)
                            row = next(rest, None)
                    zipped.writestr(INDEX, "\n".join(index) + "\n")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": pa.array([sink.at], pa.int64()), "records": pa.array([len(index)], pa.int64())})

    return rows.select("page_id", "url", "payload", "digest", "record_type", "refers_to").mapInArrow(package, "path string, size bigint, records bigint")


def directory(file, size: int) -> list[dict]:
    """Name, method, size and header offset of every member, from the central directory or its ZIP64 form."""
    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail_at = max(0, size - (1 << 16) - 22)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(END_OF_DIRECTORY)
    if end < 0 or len(tail) < end + 22:
        raise ValueError("not a ZIP package: no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == FULL_16 or length == FULL_32 or start == FULL_32:
        locator = read(tail_at + end - 20, 20) if tail_at + end >= 20 else b""
        if locator[:4] != ZIP64_LOCATOR:
            raise ValueError("ZIP64 directory is not located")
        record64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record64[:4] != ZIP64_END:
            raise ValueError("ZIP64 end of directory is missing")
        count, length, start = struct.unpack_from("<QQQ", record64, 32)
    raw, at, members = read(start, length), 0, []
    for _ in range(count):
        if raw[at:at + 4] != DIRECTORY_ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + n_name].decode()
        extra, k = raw[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == ZIP64_EXTRA:
                # Only the fields that did not fit are here, in this order.
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                full = next(wide) if full == FULL_32 else full
                packed = next(wide) if packed == FULL_32 else packed
                header = next(wide) if header == FULL_32 else header
            k += 4 + n
        members.append({"name": name, "method": method, "size": packed, "header": header})
        at += 46 + n_name + n_extra + n_note
    return members


def data_offset(file, member: dict) -> int:
    """Where a stored member's bytes begin."""
    if member["method"] != STORED:
        raise ValueError(f"{member['name']} is compressed in its package, so it has no ranges")
    file.seek(member["header"])
    local = file.read(30)
    if local[:4] != LOCAL_HEADER:
        raise ValueError(f"{member['name']} has no local header")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member["header"] + 30 + n_name + n_extra


def runs(file, size: int, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of the package with whole records, of about ``most`` bytes.

    By the index; an archive member that no index covers is one range.
    """
    members = directory(file, size)
    archives = [m for m in members if re.search(r"(^|/)archive/[^/]+\.warc(\.gz)?$", m["name"])]
    indexes = [m for m in members if re.search(r"(^|/)indexes/[^/]+\.cdxj$", m["name"])]
    for archive in archives:
        start = data_offset(file, archive)
        spans = []
        for index in indexes if len(archives) == 1 else []:
            file.seek(data_offset(file, index))
            lines = file.read(index["size"]).decode().splitlines()
            # Lines of other writers have a key and a time before the fields.
            entries = (json.loads(line[line.index("{"):]) for line in lines if "{" in line)
            spans += [(int(e["offset"]), int(e["offset"]) + int(e["length"])) for e in entries]
        if sum(b - a for a, b in spans) != archive["size"]:
            spans = [(0, archive["size"])] if archive["size"] else []
        at = None
        for a, b in sorted(spans):
            at = a if at is None else at
            if b - at >= most:
                yield start + at, start + b
                at = None
        if at is not None:
            yield start + at, start + max(b for _, b in spans)


def members_of(raw: bytes) -> Iterator[bytes]:
    """The bytes of each gzip member in turn; unpacked bytes as they are."""
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    while raw:
        unpacker = zlib.decompressobj(31)
        data = unpacker.decompress(raw) + unpacker.flush()
        if not unpacker.eof:
            raise ValueError("a record is cut off")
        yield data
        raw = unpacker.unused_data


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def records(raw: bytes) -> Iterator[dict]:
    """The records of a run: type, id, url, payload, its length and digest, and the id referred to."""
    for data in members_of(raw):
        at = 0
        while data[at:at + 5] == b"WARC/":
            body = data.index(b"\r\n\r\n", at) + 4
            fields = _fields(data[at:body])
            length = int(fields["content-length"])
            block = data[body:body + length]
            if len(block) < length:
                raise ValueError("a record is cut off")
            at = body + length + 4
            head, _, payload = block.partition(b"\r\n\r\n")
            kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
            digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
            if kind == "response" and digest not in (None, hashlib.sha1(payload).hexdigest()):
                raise ValueError(f"the payload of {fields.get('warc-record-id')} is not what its digest says")
            yield {
                "record_id": fields.get("warc-record-id", "").strip("<>"), "record_type": kind, "url": fields.get("warc-target-uri"),
                "payload": payload if kind == "response" else None, "payload_digest": digest,
                "payload_bytes": len(payload) if kind == "response" else int(_fields(head).get("content-length", 0)),
                "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
            }


RECORD = "record_id string, record_type string, url string, payload binary, payload_digest string, payload_bytes bigint, refers_to string"
_KINDS = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
])


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages in ``path``; without ``payloads``, these are checked and left out.

    Broken packages and records raise. Runs of records are dealt out over tasks, so a large package is not
    read by one.
    """
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            system, path = place(row["path"])
            with system.open_input_file(path) as file:
                found = [*runs(file, file.size())]
            yield pa.RecordBatch.from_pydict({
                "path": [row["path"]] * len(found), "start": pa.array([a for a, _ in found], pa.int64()), "stop": pa.array([b for _, b in found], pa.int64()),
            })

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            system, path = place(row["path"])
            with system.open_input_file(path) as file:
                file.seek(row["start"])
                raw = file.read(row["stop"] - row["start"])
            found = [r if payloads else r | {"payload": None} for r in records(raw)]
            yield pa.RecordBatch.from_pylist(found, _KINDS)

    ranges = packages.select("path").mapInArrow(locate, "path string, start bigint, stop bigint")
    return ranges.repartition(partitions(packages.sparkSession), "path", "start").mapInArrow(parse, RECORD)


def as_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with payload, digest, record_type and refers_to.

    Of equal payloads of at least ``least`` bytes, rows with the largest page_id are responses, the others
    revisit it, also those without page_id. Where no row has one, all are responses.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    long = rows.where(F.octet_length("payload") >= least).groupBy("digest")
    # One row a payload that occurs twice or more; Spark broadcasts the written table if it is small.
    groups = scratch.put(long.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "groups")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to packages and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Columns used: page_id, url, html; a null html is an empty payload. Repeated rows are records of
    their own. An empty table makes no package and no record.
    """
    scratch = Scratch(pages.sparkSession, "packages")
    packages = scratch.put(write(as_records(pages), f"{scratch.folder}/wacz"), "list")
    number = lambda name: F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read(packages, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
