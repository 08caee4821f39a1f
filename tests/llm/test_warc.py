import base64
import hashlib
import struct

import pytest
import zstandard

from gridloom.llm import warc
from gridloom.llm.warc import frames, page_record, parse, read_archives, write_archives


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, path string")


def round_trip(spark, rows, least=0):
    got = read_archives(write_archives(pages_of(spark, rows).repartition(3), least=least))
    return sorted(((r.record_id, r.target_uri, None if r.payload is None else bytes(r.payload), r.payload_digest, r.payload_bytes, r.record_type, r.refers_to, r.error) for r in got.collect()), key=repr)


def expected(rows, least=0):
    first, count = {}, {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, u, h in rows:
        p = (h or "").encode()
        name = "urn:page:none" if i is None else f"urn:page:{i}"
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        later = len(p) >= least and p in first and first[p] != i
        out.append((name, u or name, None if later else p, digest, len(p), "revisit" if later else "response", f"urn:page:{first[p]}" if later else None, None))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/", "<p>é one"), (2, "http://b/?q=1", "<p>é one"), (9, None, "<p>é one"), (3, "http://c", None), (4, "http://d", ""), (7, "http://e", "x" * 200_000),
    (7, "http://e", "x" * 200_000), (None, "http://f", "<p>é one"), (None, "http://f", "only null"), (11, "http://g", "two\r\n\r\nlines\r\n"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    rows = ROWS + [(100 + k, f"http://h/{k}", f"<html><body>page {k % 150} " + "some words " * (k % 150)) for k in range(300)]
    assert round_trip(spark, rows, least) == expected(rows, least)


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_dictionary_leads_and_each_record_is_a_frame():
    records = [page_record(f"urn:page:{k}", "http://x", f"<p>{k} ".encode() * 50, None, "2024-01-01T00:00:00Z") for k in range(200)]
    data = warc.archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_FRAME
    trained = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    assert trained[:4] == struct.pack("<I", warc.DICTIONARY)
    got = list(frames(memoryview(data)))
    assert [r for _, r in got] == records and got[0][0] == 8 + size
    raw = struct.pack("<II", warc.DICTIONARY_FRAME, len(trained)) + trained + data[8 + size:]  # a dictionary may be stored as it is
    assert [r for _, r in frames(memoryview(raw))] == records
    with pytest.raises(warc.BadRecord):
        list(frames(memoryview(data[8 + size:])))
    padded = data + struct.pack("<II", 0x184D2A53, 3) + b"abc"
    assert len(list(frames(memoryview(padded)))) == 200
    for cut in (len(data) - 5, 8 + size // 2, 6):
        with pytest.raises(warc.BadRecord):
            list(frames(memoryview(data[:cut])))


@pytest.mark.parametrize("old, new, message", [
    (b"WARC/1.1", b"WARC/9.9", "no WARC header"), (b"WARC-Date", b"X-Date", "warc-date is missing"), (b"hello", b"hallo", "its digest"), (b"hello", b"hello there", "Content-Length is"),
    (b"Content-Length: 5\r\n\r\n", b"Content-Length: 6\r\n\r\n", "not 6"), (b"WARC-Target-URI", b"WARC Target-URI", "malformed"), (b"HTTP/1.1 200", b"HTTQ/1.1 200", "no HTTP"),
    (b"hello\r\n\r\n", b"hello\n\n\n\n", "two line ends"),
])
def test_faults(old, new, message):
    good = page_record("urn:page:1", "http://x", b"hello", None, "2024-01-01T00:00:00Z")
    assert parse(good)["payload"] == b"hello" and old in good
    with pytest.raises(warc.BadRecord, match=message):
        parse(good.replace(old, new))


def test_reader_reports_faults_per_record(spark):
    good = [page_record(f"urn:page:{k}", "http://x\n y", b"hello", None, "2024-01-01T00:00:00Z") for k in range(3)]
    bad = good[1].replace(b"hello", b"jello")
    df = spark.createDataFrame([("a", warc.archive([good[0], bad, good[2]])), ("b", b"junkjunkjunk"), ("c", None), ("d", b"")], "path string, content binary")
    got = sorted(((r.path, r.record_id, bool(r.error)) for r in read_archives(df).collect()), key=repr)
    assert got == [("a", "urn:page:0", False), ("a", "urn:page:2", False), ("a", None, True), ("b", None, True)]
