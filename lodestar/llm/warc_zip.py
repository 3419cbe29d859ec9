"""WARC records in ZIP packages: written as stored members, read by range.

A package holds one gzip-per-record WARC member and an index member, both stored, so the
bytes of a record lie in the file as they are.  The reader parses the end records, the ZIP64
records and the central directory itself, finds the data of stored members, cuts their
index into ranges and reads only those; nothing is extracted.  A package without an index
is read member by member.

Files are reached with ``pyarrow.fs`` by URI (local and shared folders, object stores,
HDFS where its client library is installed).  Every task writes under a name of its own and
reports it; only the packages of committed tasks are in the returned list, so a lost
executor or a second attempt leaves no double records.

Cases: null html is an empty payload; a null ``page_id`` is written with a random record id,
read back as null, always a response and never referred to; several rows with the
smallest ``page_id`` of a payload are all responses; a null url is left out; an empty table
writes no package and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_partitions, stage
from lodestar.operators.skew import salted_key_join

MIN_REVISIT = 100  # payloads below this many bytes are always written whole
RANGE = 4 << 20
STEP = 1 << 14
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LISTED = "path string, size bigint, records bigint"
_RANGE = "path string, offset bigint, length bigint"
_RECORD = ("path string, offset bigint, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, payload_bytes bigint, payload binary")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- writing

def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, payload, digest, record_type, refers_to)``: the first of equal payloads
    is written whole, the others refer to it."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    both = salted_key_join(rows, first, "digest", "copies", spread_col="page_id")
    again = (F.length("payload") >= min_revisit) & (F.col("page_id") > F.col("first"))
    again = F.coalesce(again, F.lit(False))
    return both.select("page_id", "url", "payload", "digest",
                       F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("first")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def make_record(page_id, url, payload: bytes, digest: str, record_type: str, refers_to) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", "", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """One package for each task of ``records`` that has rows; returns the staged list."""
    def run(it):
        target, base = open_fs(folder)
        path, name = "", f"records-{uuid.uuid4().hex}"
        package = stream = None
        index: list[bytes] = []
        at = 0
        for batch in it:
            for r in batch.to_pylist():
                if package is None:
                    target.create_dir(base, recursive=True)
                    path = f"{base}/{name}.wacz"
                    out = target.open_output_stream(path)
                    package = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    stream = package.open(f"archive/{name}.warc.gz", "w", force_zip64=True)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(make_record(
                    r["page_id"], r["url"], r["payload"], r["digest"], r["record_type"],
                    r["refers_to"])) + packer.flush()
                stream.write(data)
                index.append(json.dumps({"member": f"archive/{name}.warc.gz", "offset": at,
                                         "length": len(data), "digest": r["digest"]}).encode() + b"\n")
                at += len(data)
        if package is not None:
            stream.close()
            package.writestr("indexes/index.cdxj", b"".join(index))
            package.close()
            out.close()
            scheme = folder.split(":", 1)[0] + ":" if re.match(r"\w+:", folder) else ""
            whole = path if not scheme else (f"file://{path}" if scheme == "file:" else
                                             f"{folder.rstrip('/')}/{name}.wacz")
            yield pa.RecordBatch.from_pydict(
                {"path": [whole], "size": [target.get_file_info(path).size], "records": [len(index)]})

    return stage(records.mapInArrow(run, _LISTED), "warc-packages")


# ---------------------------------------------------------------- the ZIP container

def directory(f, size: int) -> list[dict]:
    """The members in the central directory of an open package of ``size`` bytes."""
    tail_at = max(0, size - 65_557)  # the end record and its longest comment
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
    locator = tail_at + end - 20
    if locator >= 0:
        f.seek(locator)
        mark = f.read(20)
        if mark[:4] == b"PK\x06\x07":  # the ZIP64 end record has the true numbers
            f.seek(struct.unpack("<Q", mark[8:16])[0])
            wide = f.read(56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("ZIP64 end record not found")
            entries, length, start = struct.unpack("<QQQ", wide[32:56])
    f.seek(start)
    data, at, out = f.read(length), 0, []
    for _ in range(entries):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", data[at + 8:at + 12])
        packed, plain, n, m, k = struct.unpack("<IIHHH", data[at + 20:at + 34])
        header, = struct.unpack("<I", data[at + 42:at + 46])
        name = data[at + 46:at + 46 + n]
        extra = data[at + 46 + n:at + 46 + n + m]
        while len(extra) >= 4:
            kind, size_of = struct.unpack("<HH", extra[:4])
            if kind == 1:  # the fields that do not fit above, in this order
                wide, values = extra[4:4 + size_of], []
                for value in (plain, packed, header):
                    if value == 0xFFFFFFFF:
                        value, = struct.unpack("<Q", wide[:8])
                        wide = wide[8:]
                    values.append(value)
                plain, packed, header = values
            extra = extra[4 + size_of:]
        out.append({"name": name.decode("utf-8" if flags & 0x800 else "cp437"), "method": method,
                    "header": header, "size": packed, "plain": plain})
        at += 46 + n + m + k
    return out


def data_offset(f, member: dict) -> int:
    """Where the bytes of a stored member begin."""
    if member["method"] != 0:
        raise ValueError(f"{member['name']} is compressed; ranges need stored members")
    f.seek(member["header"])
    local = f.read(30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member['name']}")
    n, m = struct.unpack("<HH", local[26:30])
    return member["header"] + 30 + n + m


# ---------------------------------------------------------------- reading

def _open(uri: str):
    source, path = open_fs(uri)
    return source.open_input_file(path)


def record_ranges(packages: DataFrame, limit: int = RANGE) -> DataFrame:
    """``(path, offset, length)`` of runs of whole records, about ``limit`` bytes each."""
    def run(it):
        for batch in it:
            for path in batch.column("path").to_pylist():
                with _open(path) as f:
                    members = {m["name"]: m for m in directory(f, f.size())}
                    archives = {n: data_offset(f, m) for n, m in members.items()
                                if n.endswith((".warc", ".warc.gz"))}
                    indexed = set()
                    ranges = []
                    for name, m in members.items():
                        if not name.endswith(".cdxj"):
                            continue
                        f.seek(data_offset(f, m))
                        for line in f.read(m["size"]).splitlines():
                            x = json.loads(line[line.index(b"{"):])
                            indexed.add(x["member"])
                            at = archives[x["member"]] + x["offset"]
                            if ranges and ranges[-1][0] + ranges[-1][1] == at and ranges[-1][1] < limit:
                                ranges[-1][1] += x["length"]
                            else:
                                ranges.append([at, x["length"]])
                    ranges += [[archives[n], members[n]["size"]] for n in archives if n not in indexed]
                if ranges:
                    offset, length = zip(*ranges)
                    yield pa.RecordBatch.from_pydict({"path": [path] * len(ranges), "offset": offset,
                                                      "length": length})

    return packages.select("path").mapInArrow(run, _RANGE)


def parse_records(data: bytes):
    """``(offset, headers, block)`` of the records in ``data``, plain or gzip each."""
    at = 0
    while at < len(data):
        begin = at
        if data[at:at + 2] == b"\x1f\x8b":
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:  # small steps, so that what follows is not copied each time
                parts.append(unpack.decompress(data[at:at + STEP]))
                at += min(STEP, len(data) - at)
                if at >= len(data) and not unpack.eof:
                    raise ValueError("a record ends early")
            record = b"".join(parts)
            at -= len(unpack.unused_data)
        else:
            head = data.index(b"\r\n\r\n", at) + 4
            size = int(re.search(rb"(?im)^content-length:\s*(\d+)", data[at:head])[1])
            record, at = data[at:head + size + 4], head + size + 4
        head, block = record.split(b"\r\n\r\n", 1)
        lines = head.decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        yield begin, headers, block[:int(headers["content-length"])]


def _page(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_records(ranges: DataFrame) -> DataFrame:
    """The records in the ranges; a response's digest is checked against its payload."""
    def run(it):
        for batch in it:
            for r in batch.to_pylist():
                with _open(r["path"]) as f:
                    f.seek(r["offset"])
                    data = f.read(r["length"])
                rows = []
                for at, h, block in parse_records(data):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = h["warc-type"]
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
                    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
                    if kind == "response" and (len(payload) != size or
                                               hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {h['warc-record-id']} is damaged")
                    rows.append((r["path"], r["offset"] + at, kind, _page(h["warc-record-id"]),
                                 h.get("warc-target-uri"), _page(h.get("warc-refers-to")), digest,
                                 size, payload if kind == "response" else None))
                columns = list(zip(*rows)) if rows else [()] * 9
                kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    [x.split()[0] for x in _RECORD.split(", ")])

    n = shuffle_partitions(ranges.sparkSession)
    return ranges.repartition(n).mapInArrow(run, _RECORD)


def page_of(record: str) -> F.Column:
    """The page id in a record id, null for the random ones."""
    return F.regexp_extract(record, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")
