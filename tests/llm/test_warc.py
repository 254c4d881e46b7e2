import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gatelog.llm import warc
from gatelog.session import scratch_dir

PAGES = "page_id long, url string, html string, payload string"
TRICKY = [
    "a\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n" * 50, "\r\n\r\n", "x\r\n" * 600, "\r\n" * 700, "\r" * 1200,
    "\n\r\n\r\r\n\r\n" * 300, None, "", "é" * 900, "é" * 900, "z" * 999, "z" * 999, "q" * 1000, "q" * 1000, "q" * 1000,
]


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://h/{i}\r\nX: {i}", html, "own") for i, html in enumerate(TRICKY)]
    return spark.createDataFrame([*rows, (None, None, "q" * 1000, None), (14, "again", "q" * 1000, None)], PAGES).repartition(4)


def by_hand(rows):
    groups = defaultdict(list)
    for page_id, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        known = [p for p in groups[html or ""] if p is not None]
        again = len(data) >= 1000 and len(groups[html or ""]) > 1 and bool(known) and page_id != max(known)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(known) if again else None))
    return sorted(out, key=repr)


def test_payloads_that_look_like_records(pages):
    got = warc.round_trip(pages)
    rows = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr)
    assert rows == by_hand([(r.page_id, r.html) for r in pages.collect()])


def test_payloads_come_back_byte_for_byte_and_revisits_have_none(spark, pages):
    path = scratch_dir(spark, "warc-test")
    warc.write(warc.resolve(pages), path)
    got = warc.read(spark, path).filter("record_type = 'response'")
    want = {(r.html or "").encode() for r in pages.collect()}
    assert {bytes(r.payload) for r in got.collect()} == want
    assert warc.read(spark, path).filter("record_type = 'revisit'").agg(F.max("payload")).first()[0] is None


def test_every_page_is_restored(spark, pages):
    path = scratch_dir(spark, "warc-test")
    warc.write(warc.resolve(pages), path)
    got = sorted(((r.page_id, bytes(r.payload)) for r in warc.restored(spark, path).collect()), key=repr)
    assert got == sorted(((None if r.page_id is None else str(r.page_id), (r.html or "").encode()) for r in pages.collect()), key=repr)


def test_foreign_revisits(spark, tmp_path):
    """By record id, by digest without one, and one whose original is not there; files in any order."""
    import gzip

    sha = hashlib.sha1(b"page").hexdigest()
    first = record("revisit", b"", WARC_Record_ID="<b>", WARC_Refers_To="<a>", WARC_Payload_Digest=f"sha1:{sha}", WARC_Target_URI="http://b/")
    first += record("revisit", b"", WARC_Record_ID="<c>", WARC_Payload_Digest=f"sha1:{sha}", WARC_Target_URI="http://c/")
    first += record("revisit", b"", WARC_Record_ID="<d>", WARC_Refers_To="<gone>", WARC_Payload_Digest=f"sha1:{sha}", WARC_Target_URI="http://d/")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(first))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("response", b"page", WARC_Record_ID="<a>", WARC_Target_URI="http://a/")))
    got = {r.record_id: r.payload and bytes(r.payload) for r in warc.restored(spark, str(tmp_path)).collect()}
    assert got == {"<a>": b"page", "<b>": b"page", "<c>": b"page", "<d>": None}


def test_file_is_a_valid_archive(spark, pages):
    """Parsed by the format's rules: version, header lines, Content-Length, two line ends."""
    path = scratch_dir(spark, "warc-test")
    warc.write(warc.resolve(pages.filter("page_id = 0")), path)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/*.gz").collect())
    import gzip

    data = gzip.decompress(data)
    header, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(b": ", 1) for line in header.split(b"\r\n")[1:])
    assert header.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Target-URI"] == b"http://h/0%20%20X:%200"
    size = int(fields[b"Content-Length"])
    assert rest[:size].decode() == TRICKY[0] and rest[size:] == b"\r\n\r\n"


def test_a_damaged_payload_raises():
    data = bytearray(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nWARC-Payload-Digest: sha1:0\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    fields, begin, _ = warc.head(data)
    with pytest.raises(ValueError, match="does not match"):
        warc.content(fields, data, begin)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def record(kind, block, version="1.1", **fields):
    named = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    head = f"WARC/{version}\r\nWARC-Type: {kind}\r\n{named}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Version 1.0, other record types, an HTTP head, a digest in base 32, and none."""
    import base64
    import gzip
    import hashlib

    page = b"<p>line\r\n\r\nWARC/1.0\r\n end</p>"
    code = base64.b32encode(hashlib.sha1(page).digest()).decode()
    data = record("warcinfo", b"software: x\r\n", "1.0")
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + page
    data += record("response", http, "1.0", Content_Type="application/http; msgtype=response", WARC_Target_URI="http://a/", WARC_Payload_Digest=f"sha1:{code}")
    data += record("request", b"GET /", "1.0") + record("response", b"plain", "1.1", warc_target_uri="http://b/")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    found = sorted((r.url, bytes(r.payload), r.payload_digest) for r in warc.read(spark, str(tmp_path)).collect())
    assert found == [("http://a/", page, hashlib.sha1(page).hexdigest()), ("http://b/", b"plain", hashlib.sha1(b"plain").hexdigest())]


@pytest.mark.parametrize("damage", [lambda d: d[:-40], lambda d: d[:-4] + b"junk", lambda d: b"x" + d, lambda d: d.replace(b"WARC/1.1", b"WARC/9.9")])
def test_damaged_archives_raise(spark, tmp_path, damage):
    import gzip

    data = b"".join(record("response", bytes([65 + i]) * 100, WARC_Target_URI=f"http://{i}/") for i in range(3))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(damage(data)))
    with pytest.raises(Exception, match="record|digest"):
        warc.read(spark, str(tmp_path)).collect()
