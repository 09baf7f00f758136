import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
from pathlib import Path

import pytest

from newsrisk.llm import warc_archive as W
from newsrisk.llm.common import table_path

PAGES = [(3, "u3", "<p>a</p>"), (1, "u1", "<p>a</p>"), (2, None, None), (5, "u 5\n", ""), (4, "u4", "é" * 50_000), (7, "u7", "<p>a</p>"), (None, "u", "lone"), (9, "u9", "b\r\n\r\nc"), (9, "u9", "b\r\n\r\nc"), (None, "u", "<p>a</p>")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "page_id long, url string, html string, first long, salt long, digest string")


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        to = first.get(h or "") if len(p) >= min_bytes else None
        to = None if to == i else to
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5, 100])
def test_round_trip(spark, min_bytes):
    got = W.round_trip(pages(spark), min_bytes).collect()
    assert all(r.intact for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(PAGES, min_bytes)


def test_hot_payload_and_small_archives(spark):
    rows = [(i, f"u{i}", "same" if i % 3 else f"own {i}" * 50) for i in range(400)]
    folder = table_path(spark, "warc")
    manifest = W.write_archives(pages(spark, rows), folder, max_archive_bytes=2000)
    assert manifest.count() > 5 and manifest.agg({"records": "sum"}).first()[0] == 400
    got = W.read_records(W.locate(manifest, folder), folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    html = {r[0]: r[2] for r in rows}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in got if r.record_type == "response")
    # any ZIP and WARC reader understands the files
    one = next(Path(folder.removeprefix("file://")).glob("*.zip"))
    with zipfile.ZipFile(one) as z:
        assert z.testzip() is None and z.namelist() == [W.DATA, W.INDEX] and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
        data = z.read(W.DATA)
        for line in z.read(W.INDEX).decode().splitlines():
            x = json.loads(line)
            assert gzip.decompress(data[x["offset"] : x["offset"] + x["length"]]).startswith(b"WARC/1.1\r\n")


def test_members_of_plain_and_zip64_directories():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"first")
        with z.open("b", "w", force_zip64=True) as f:
            f.write(b"second")
        z.comment = b"a comment"
    data = out.getvalue()
    read = lambda at, n: data[at : at + n]
    assert {n: data[at : at + size] for n, m, at, size in W.members(read, len(data))} == {"a": b"first", "b": b"second"}
    # the same directory behind a ZIP64 end record
    end = data.rfind(b"PK\x05\x06")
    n, length, at = struct.unpack("<HII", data[end + 10 : end + 20])
    wide = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, length, at) + struct.pack("<IIQI", 0x07064B50, 0, end, 1)
    data = data[:end] + wide + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert {n: data[at : at + size] for n, m, at, size in W.members(read, len(data))} == {"a": b"first", "b": b"second"}
    with pytest.raises(ValueError):
        list(W.members(lambda at, n: b"x" * n, 100))


def test_empty_table(spark):
    assert W.round_trip(pages(spark, [])).count() == 0
