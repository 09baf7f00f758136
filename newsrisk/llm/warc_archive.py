"""ZIP-packaged WARC archives: write, read the directories, range-read records without extraction.

Writing: every task streams its pages into archives of its own in the shared folder, each a ZIP
with two stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (offset and length of each record). An archive's name is unique to the
task attempt and only the archives named in the written manifest exist for readers, so a retried
task leaves no half-written archive in the result. Reading: the end record, the ZIP64 end record
and the central directory give the members; a stored member's bytes lie at a known place, so the
index and then each record are read by range, by many tasks per archive.

Of records with equal payloads of at least ``min_bytes`` that with the smallest page_id is the
response, the others are revisits that refer to it. The smallest id per digest is found over salted
groups, so a payload that a third of all pages share is never gathered in one task.

Defined cases: a null html is an empty payload; a null url becomes ``urn:page:<id>``; repeated rows
give repeated records of the same type; rows with a null page_id come back with a null page_id, as
revisits if a page with an id has their payload, else as responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import io
import json
import struct
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import table_path, write_table

MIN_BYTES = 0
MAX_ARCHIVE_BYTES = 256 << 20
READ_BYTES = 8 << 20  # bytes of records that one reading task gets
SALTS = 64
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAIL = 22 + 65535 + 20  # the end record, its longest comment, the ZIP64 locator before it


def filesystem(uri: str):
    """(file system, path) of a folder or file URI; a plain path is local. Arrow knows S3 by its plain scheme only."""
    from pyarrow import fs

    uri = re.sub("^s3[an]://", "s3://", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record (not compressed): a response, or a revisit if ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    target = f"urn:page:{name}" if url is None else "".join(url.split())
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest32(payload)}", f"Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:20]!r}")
    headers = dict(x.split(": ", 1) for x in lines)
    return headers, rest[: int(headers["Content-Length"])]


class ArchiveWriter:
    """Streams records into one ZIP (unseekable target, ZIP64 sizes) and then its index."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data, self.at, self.lines = self.zip.open(DATA, "w", force_zip64=True), 0, io.StringIO()
        self.records = 0

    def add(self, page_id, raw: bytes):
        packed = gzip.compress(raw, compresslevel=1, mtime=0)
        self.data.write(packed)
        self.lines.write(json.dumps({"page_id": page_id, "offset": self.at, "length": len(packed)}) + "\n")
        self.at += len(packed)
        self.records += 1

    def close(self):
        self.data.close()
        self.zip.writestr(INDEX, self.lines.getvalue())
        self.zip.close()


def members(read, size: int):
    """(name, method, data offset, stored bytes) of a ZIP's members; ``read(offset, n)`` gives a range."""
    start = max(0, size - TAIL)
    tail = read(start, size - start)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no ZIP end record")
    entries, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":  # ZIP64 locator
        (wide,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        entries, length, at = struct.unpack("<QQQ", read(wide, 56)[32:56])
    directory, p = read(at, length), 0
    for _ in range(entries):
        sig, _, _, flags, method, _, _, _, stored, plain, n, extra, comment, _, _, _, local = struct.unpack("<IHHHHHHIIIHHHHHII", directory[p : p + 46])
        if sig != 0x02014B50:
            raise ValueError("damaged central directory")
        name = directory[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        x, p = directory[p + 46 + n : p + 46 + n + extra], p + 46 + n + extra + comment
        while len(x) >= 4:  # the ZIP64 field holds, in order, what did not fit
            tag, m = struct.unpack("<HH", x[:4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{m // 8}Q", x[4 : 4 + m // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            x = x[4 + m :]
        head = read(local, 30)
        yield name, method, local + 30 + sum(struct.unpack("<HH", head[26:30])), stored


def with_references(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages with ``refers_to``: the smallest page_id of their payload, null for responses."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary")))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    large = p.where(F.octet_length("html") >= min_bytes) if min_bytes > 0 else p
    salted = write_table(large.groupBy("digest", "salt").agg(F.min("page_id").alias("smallest")), "salted")
    first = write_table(salted.groupBy("digest").agg(F.min("smallest").alias("first")).where("first is not null"), "first")
    first = write_table(salted.select("digest", "salt").join(first, "digest"), "first_by_salt")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    return p.join(first, ["digest", "salt"], "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, max_archive_bytes: int = MAX_ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as WARC records into ZIP archives below ``folder``; the manifest (archive, bytes, records)."""

    def run(batches):
        target, folder_path = filesystem(folder)
        target.create_dir(folder_path, recursive=True)
        out = stream = name = None

        def closed():
            out.close()
            size = stream.tell()
            stream.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "bytes": [size], "records": [out.records]}, schema=kinds)

        kinds = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
        for b in batches:
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    stream = target.open_output_stream(f"{folder_path}/{name}")
                    out = ArchiveWriter(stream)
                out.add(page_id, record(page_id, url, html.encode(), refers))
                if out.at >= max_archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return write_table(with_references(pages, min_bytes).mapInArrow(run, "archive string, bytes long, records long"), "manifest")


def locate(manifest: DataFrame, folder: str) -> DataFrame:
    """(archive, offset, length) of every record, from the archives' directories and stored indexes."""

    def run(batches):
        target, folder_path = filesystem(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with target.open_input_file(f"{folder_path}/{name}") as f:
                    found = {n: (m, at, size) for n, m, at, size in members(lambda at, n: f.read_at(n, at), f.size())}
                    for n in (DATA, INDEX):
                        if found[n][0] != zipfile.ZIP_STORED:
                            raise ValueError(f"{name}: {n} is not stored")
                    at, size = found[INDEX][1:]
                    rows = [json.loads(x) for x in f.read_at(size, at).decode().splitlines()]
                start = found[DATA][1]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array([start + r["offset"] for r in rows], pa.int64()), pa.array([r["length"] for r in rows], pa.int64())], names=["archive", "offset", "length"])

    return manifest.select("archive").mapInArrow(run, "archive string, offset long, length long")


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean, payload binary"


def read_records(located: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Range-read the located records; ``intact``: a response's payload has the digest and length it states."""

    def run(batches):
        target, folder_path = filesystem(folder)
        number = lambda x: None if x == "null" else int(x)
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()), ("payload", pa.binary())])
        name = f = None
        for b in batches:
            rows = []
            for archive, at, n in zip(*(c.to_pylist() for c in b.columns)):
                if archive != name:
                    if f is not None:
                        f.close()
                    name, f = archive, target.open_input_file(f"{folder_path}/{archive}")
                h, block = parse(gzip.decompress(f.read_at(n, at)))
                payload = block.partition(b"\r\n\r\n")[2] if h["WARC-Type"] == "response" else None
                digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["Payload-Length"])
                page = number(h["WARC-Record-ID"][len("<urn:page:") : -1])
                refers = number(h["WARC-Refers-To"][len("<urn:page:") : -1]) if "WARC-Refers-To" in h else None
                intact = payload is None or (digest32(payload) == digest and len(payload) == size)
                rows.append((page, h["WARC-Target-URI"], size, digest, h["WARC-Type"], refers, intact, payload if payloads else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], schema=kinds)
        if f is not None:
            f.close()

    return located.mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all pages, read the archives back: one row per record, without the payload."""
    folder = table_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    size = manifest.agg(F.sum("bytes")).first()[0] or 0
    located = locate(manifest, folder)
    tasks = max(1, -(-size // READ_BYTES))
    dealt = located.repartition(tasks, "archive", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("archive", "offset")
    return read_records(dealt, folder, payloads=False).drop("payload")
