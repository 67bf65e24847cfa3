"""WARC records in ZIP packages, written and range-read without extraction.

A package holds an archive member (``archive/data.warc.gz``: one gzip member
per record) and an index member (``indexes/index.tsv``: offset and length of
each record), both stored, so a record is a byte range of the package. The
reader finds the central directory from the end of the file (ZIP64 records
included), locates the members' bytes, reads the index, and hands out the
ranges as rows; tasks then read exactly those bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_folder, prepare, publishing, reader, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.tsv"
LEAST_PAYLOAD = 1000           # smaller payloads are never revisits
RANGE = 4 << 20                # bytes of a package that are read by one task at least
DATE = "1970-01-01T00:00:00Z"
_READ = 4 << 20
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


# ---- records ---------------------------------------------------------------

def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, name: str) -> bytes:
    """A response (HTTP head and payload) or a revisit (HTTP head only)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    uri = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page: {refers_to}")
    if page_id is not None:
        lines.append(f"X-Page: {page_id}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), HTTP head and payload of one record."""
    end = raw.index(b"\r\n\r\n")
    version, *lines = raw[:end].decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:20]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(fields["content-length"])
    block = raw[end + 4:end + 4 + size]
    if len(block) < size:
        raise ValueError("truncated WARC record")
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, head, payload


# ---- packages --------------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int                # offset of the local header

    def place(self, file) -> int:
        """First byte of the member's data."""
        local = file.read_at(30, self.header)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {self.name}")
        name, extra = struct.unpack("<HH", local[26:30])
        return self.header + 30 + name + extra


def directory(file) -> tuple[int, int, int]:
    """Entries, size and offset of the central directory."""
    total = file.size()
    tail_at = max(0, total - 22 - 0xFFFF)
    tail = file.read_at(total - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack("<H", tail[at + 20:at + 22])[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    entries, size, offset = struct.unpack("<HII", tail[at + 10:at + 20])
    if entries == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = file.read_at(20, tail_at + at - 20) if tail_at + at >= 20 else b""
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = file.read_at(56, struct.unpack("<Q", locator[8:16])[0])
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, size, offset = struct.unpack("<QQQ", end64[32:56])
    return entries, size, offset


def members(file) -> list[Member]:
    """Members of a package, from its central directory."""
    entries, size, offset = directory(file)
    data, at, out = file.read_at(size, offset), 0, []
    for _ in range(entries):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<HH", data[at + 8:at + 12])
        packed, plain, n, e, c = struct.unpack("<IIHHH", data[at + 20:at + 34])
        header = struct.unpack("<I", data[at + 42:at + 46])[0]
        name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = data[at + 46 + n:at + 46 + n + e], 0
        while x + 4 <= len(extra):
            tag, length = struct.unpack("<HH", extra[x:x + 4])
            if tag == 1:                                           # ZIP64: only the saturated fields, in this order
                wide = list(struct.unpack(f"<{length // 8}Q", extra[x + 4:x + 4 + length // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            x += 4 + length
        if flags & 1:
            raise ValueError(f"{name} is encrypted")
        out.append(Member(name, method, packed, header))
        at += 46 + n + e + c
    return out


def index_rows(file) -> Iterator[list[tuple[int, int]]]:
    """Places (offset in the package, length) of the records, in parts."""
    by_name = {m.name: m for m in members(file)}
    data, index = by_name[DATA], by_name[INDEX]
    for m in (data, index):
        if m.method != 0:
            raise ValueError(f"{m.name} isn't stored")
    base, at, rest = data.place(file), index.place(file), b""
    stop = at + index.size
    while at < stop:
        chunk = file.read_at(min(_READ, stop - at), at)
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        yield [(base + int(o), int(n)) for o, n in (x.split(b"\t") for x in lines)]
    if rest:
        raise ValueError("truncated index")


def _write(folder: str):
    def run(batches):
        uri, places, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip", [], 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with publishing(uri) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            with package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
                batch, at = first, 0
                while batch is not None:
                    for row in zip(*(c.to_pylist() for c in batch.columns)):
                        page_id, url, payload, digest, size, kind, refers_to = row
                        raw = gzip.compress(record(kind, page_id, url, payload or b"", digest, size, refers_to, f"{uri}#{n}"), 5, mtime=0)
                        data.write(raw)
                        places.append(f"{at}\t{len(raw)}\n")
                        at += len(raw)
                        n += 1
                    batch = next(batches, None)
            with package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
                for i in range(0, len(places), 10000):
                    index.write("".join(places[i:i + 10000]).encode())
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64())], names=["package", "records"])
    return run


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """A WARC record per row of ``pages`` (``page_id, url, html``), one package
    per task below ``folder``. Returns ``package, records``.

    Of the rows whose payload (html in UTF-8, null: empty) is equal and of at
    least 1000 bytes, those with the largest ``page_id`` are responses and
    the others revisits without payload; smaller payloads are responses.
    """
    prepare(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    src = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
           .select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size")))
    equal = (src.where(F.col("size") >= LEAST_PAYLOAD).groupBy("digest", "size").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "size", "largest"))
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    rows = (src.join(equal, ["digest", "size"], "left")
            .select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "size",
                    F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("largest")).alias("refers_to")))
    return stored(rows.mapInArrow(_write(folder), "package string, records bigint"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of
    every record of the packages (column ``package``), each read by its range."""
    prepare(packages.sparkSession)

    def locate(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for part in index_rows(reader(uri)):
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * len(part), pa.string()), pa.array([p[0] for p in part], pa.int64()),
                                                      pa.array([p[1] for p in part], pa.int64())], names=["package", "at", "length"])

    def read(batches):
        name, file = None, None
        for batch in batches:
            rows = []
            for uri, at, length in zip(*(c.to_pylist() for c in batch.columns)):
                if uri != name:
                    name, file = uri, reader(uri)
                fields, head, payload = parse_record(zlib.decompress(file.read_at(length, at), 31))
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response":
                    size, real = len(payload), hashlib.sha1(payload).hexdigest()
                    if real != digest:
                        raise ValueError(f"{uri}: damaged payload at {at}")
                else:
                    size = int(re.search(rb"(?mi)^content-length: *(\d+)", head)[1])
                page, to = fields.get("x-page"), fields.get("x-refers-to-page")
                rows.append((None if page is None else int(page), size, digest, kind, None if to is None else int(to)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    places = packages.select("package").where("package is not null").distinct().mapInArrow(locate, "package string, at bigint, length bigint")
    # Runs of neighbouring records stay together, so a task reads on in a package.
    # A number of partitions that is given isn't coalesced, small as the rows are that say what to read.
    width = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = places.repartition(width, "package", F.expr(f"at div {RANGE}")).sortWithinPartitions("package", "at")
    return spread.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` into packages and reads them back: one row per page.

    Null html is an empty payload; a null ``page_id`` comes back as null (and
    is never the largest of its group unless all are null: then they are all
    responses); repeated rows give a record each, and rows that share the
    largest ``page_id`` of a group are all responses. An empty table gives
    an empty result; other columns are ignored.
    """
    return read_packages(write_packages(pages, folder or fresh_folder(pages.sparkSession, "warc")))
