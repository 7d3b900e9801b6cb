"""Web archives in ZIP packages: WARC records written by tasks, and read back by byte ranges.

A package is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (one line a record with its offset and length). The reader never unpacks it: it reads the
end of the file, finds the central directory (also by ZIP64 records), locates the stored members by their local
headers, reads the index, and then reads the records by byte ranges, neighbours together.

Of records with equal payloads of at least ``least`` bytes the one with the smallest id is a response; the
others are revisits, which carry no payload but its digest and the id that they refer to.

Scale: a task writes packages of about ``package_bytes`` into the folder as it reads its rows, and holds one at
a time; there is no order between packages, hence no shuffle of payloads beyond the join that marks revisits. The
name of a package carries the id of the task attempt, and only packages that a finished task listed are read,
so a task that is run again leaves nothing that counts twice. Files are reached through pyarrow's file systems
by URI (local, hdfs, s3, gs).

Defined cases: a null payload is empty; payloads below ``least`` bytes are all responses; rows that share the smallest
id of a payload are all responses; null ids never are what others refer to; a null address is an empty header;
line breaks in addresses become spaces; an empty table gives no packages and no records; a broken package
(no directory, a compressed archive, a wrong digest) raises ValueError.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.llm.common import query, table
from inkprint.session import materialize, scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
WINDOW = 1 << 20  # bytes of neighbouring records read at once
_URN = "urn:page:"
# The formats' own markers
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


@dataclass
class Member:
    name: str
    method: int
    size: int  # as stored
    header: int  # offset of the local header


class Package:
    """A ZIP file behind ``read(offset, length)``."""

    def __init__(self, read, size: int):
        self._read = read
        tail_at = max(0, size - 65557)  # the end record and the longest comment
        tail = read(tail_at, size - tail_at)
        at = tail.rfind(_END)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        locator = read(tail_at + at - 20, 20) if tail_at + at >= 20 else b""
        if locator[:4] == _LOCATOR64:
            end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != _END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<QQQ", end64, 32)
        self.members = {m.name: m for m in _directory(read(start, length), count)}

    def data_at(self, name: str) -> tuple[int, Member]:
        """Where the bytes of a member begin."""
        member = self.members.get(name)
        if member is None:
            raise ValueError(f"no member {name}")
        head = self._read(member.header, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        return member.header + 30 + sum(struct.unpack_from("<HH", head, 26)), member

    def content(self, name: str) -> bytes:
        at, member = self.data_at(name)
        raw = self._read(at, member.size)
        if member.method not in (0, 8):
            raise ValueError(f"unknown compression of {name}")
        return raw if member.method == 0 else zlib.decompress(raw, -15)

    def records(self, window: int = WINDOW):
        """(index entry, bytes) of all indexed records, by ranges of about ``window`` bytes."""
        base, member = self.data_at(ARCHIVE)
        if member.method != 0:
            raise ValueError("the archive is compressed inside the package")
        group: list[dict] = []
        for line in self.content(INDEX).splitlines():
            entry = json.loads(line)
            if group and (entry["offset"] != group[-1]["offset"] + group[-1]["length"]
                          or entry["offset"] + entry["length"] - group[0]["offset"] > window):
                yield from self._range(base, group)
                group = []
            group.append(entry)
        if group:
            yield from self._range(base, group)

    def _range(self, base: int, group: list[dict]):
        start = group[0]["offset"]
        block = self._read(base + start, group[-1]["offset"] + group[-1]["length"] - start)
        for entry in group:
            at = entry["offset"] - start
            yield entry, block[at:at + entry["length"]]


def _directory(raw: bytes, count: int):
    at = 0
    for _ in range(count):
        if raw[at:at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        stored, full, name_length, extra_length, comment_length = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + name_length].decode()
        extra = raw[at + 46 + name_length:at + 46 + name_length + extra_length]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                stored = wide.pop(0) if stored == 0xFFFFFFFF else stored
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            extra = extra[4 + length:]
        yield Member(name, method, stored, header)
        at += 46 + name_length + extra_length + comment_length


def record(page: str, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC record, as a gzip member."""
    address = " ".join((url or "").split("\n")).replace("\r", " ")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    more = "" if refers_to is None else f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <{_URN}{refers_to}>\r\n"
    head = (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{_URN}{page}>\r\nWARC-Target-URI: {address}\r\n"
            f"WARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:{digest}\r\n{more}"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n").encode()
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """The record of a gzip member: its fields and, of a response, its payload; checks the digest."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    urn = lambda x: x.strip("<>").removeprefix(_URN) if x else None
    out = {"page": urn(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "type": fields["WARC-Type"],
           "refers_to": urn(fields.get("WARC-Refers-To")), "size": size, "digest": digest, "payload": None}
    if out["type"] == "response":
        found = hashlib.sha256(payload).hexdigest()
        if found != digest or len(payload) != size:
            raise ValueError(f"record {out['page']}: wrong payload")
        out["payload"], out["digest"] = payload, found
    return out


def package(records: list[tuple[str, bytes]], force_zip64: bool = False) -> bytes:
    """A ZIP package of (id, gzip member) records."""
    out, index, at = io.BytesIO(), [], 0
    for page, member in records:
        index.append(json.dumps({"id": page, "offset": at, "length": len(member)}))
        at += len(member)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for name, parts in ((ARCHIVE, [m for _, m in records]), (INDEX, ["\n".join(index).encode()])):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=force_zip64) as f:
                for part in parts:
                    f.write(part)
    return out.getvalue()


def _write(folder: str, package_bytes: int):
    def run(batches):
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        context = TaskContext.get()
        held: list[tuple[str, bytes]] = []
        size = written = 0

        def flush():
            nonlocal held, size, written
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{written:04d}.wacz"
            data = package(held)
            with files.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            row = pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [len(held)], "bytes": [len(data)]})
            held, size, written = [], 0, written + 1
            return row

        for batch in batches:
            for page, url, digest, n, refers_to, html in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((page, record(page, url, html or b"", digest, n, refers_to)))
                size += len(held[-1][1])
                if size >= package_bytes:
                    yield flush()
        if held:
            yield flush()
    return run


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   least: int = 100, package_bytes: int = 8 << 20) -> DataFrame:
    """Writes the rows as packages below ``folder``; returns the list of packages (path, records, bytes)."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload").cast("long"))
    shared = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("same")) \
        .where((F.col("same") > 1) & F.col("first").isNotNull()).select("digest", "first")
    shared = materialize(shared, "payloads")
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")) & (F.col("n") >= least), F.col("first").cast("string"))
    marked = rows.join(shared, "digest", "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("page"), "url", "digest", "n", refers.alias("refers_to"),
        F.when(refers.isNull(), F.col("payload")).alias("payload"))
    return materialize(marked.mapInArrow(_write(folder, package_bytes), "path string, records long, bytes long"), "packages")


def _read(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            files, name = pyarrow.fs.FileSystem.from_uri(path)
            with files.open_input_file(name) as f:
                rows = []
                for _, member in Package(lambda at, n: f.read_at(n, at), f.size()).records():
                    rows.append(parse(member))
                    if len(rows) >= 256:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)


_RECORD = "page string, url string, type string, refers_to string, size long, digest string, payload binary"


def _rows(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("page", pa.string()), ("url", pa.string()), ("type", pa.string()), ("refers_to", pa.string()),
                        ("size", pa.int64()), ("digest", pa.string()), ("payload", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema)


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of packages (a column path); there are as many tasks as packages."""
    out = packages.select("path").repartition(max(1, packages.count()), "path").mapInArrow(_read, _RECORD)
    return out if payloads else out.drop("payload")


_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)"""


@query("op6_warc", _SQL)
def op6(spark, d):
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    records = read_packages(write_packages(table(spark, d, "pages"), folder), payloads=False)
    return records.select(
        F.when(F.col("page") != "null", F.col("page")).cast("long").alias("page_id"), F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"))
