"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Archives are rows ``(path, content)``, which is what Spark's binary-file reader gives for ``*.warc.zst`` files too.  The writer makes them
as rows as well, since Spark's tasks have no other portable way to write bytes into a shared store; written as Parquet they can be read back
or put into files one by one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python
from gridloom.session import materialise

#: Magic numbers of the formats: a skippable frame that holds a dictionary, a plain frame, a finished dictionary.
DICTIONARY_FRAME, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
#: Uncompressed bytes after which a new archive begins, bytes of records a dictionary is trained on (per archive) and its size.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 16 << 20, 2 << 20, 32 << 10
#: The largest record a reader accepts.
RECORD_BYTES = 1 << 30
_REQUIRED = ("warc-record-id", "warc-type", "warc-date", "content-length")
_STEP = 1 << 16


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(name: str, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A response record of the payload, or a revisit record that has its HTTP headers only and names the record with the same payload."""
    target = quote(uri, safe="!#$%&'()*+,/:;=?@[]~") if uri else name
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
    ]
    if refers_to:
        headers += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record(headers, http if refers_to else http + payload)


def archive(records: list[bytes]) -> bytes:
    """The records as frames behind a dictionary trained on the first of them; without a dictionary where there is too little to train on."""
    samples, size = [], 0
    for r in records:
        if size > SAMPLE_BYTES:
            break
        samples.append(r)
        size += len(r)
    head, trained = b"", None
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        pass
    if trained is not None:
        packed = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
        head = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
    one = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
    return head + b"".join(one.compress(r) for r in records)


def write_archives(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``(path, content)``: archives with one record per row of `pages`.

    Of records with equal payloads of at least `least` bytes, the one with the smallest id is the response, the others are revisits of it;
    smaller ones are all responses.  A null payload is empty.  Rows that repeat that smallest id are responses each; a null id is larger
    than all others.  A null url is replaced by the record's name.  An empty table gives no archive; other columns are not read.
    """
    digest = F.sha1(F.coalesce(F.col(payload), F.lit("")).cast("binary"))
    size = F.octet_length(F.coalesce(F.col(payload), F.lit("")))
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"), digest.alias("digest"), size.alias("size"))
    marks = materialise(rows.filter(F.col("size") >= least).select("id", "digest"))
    first = marks.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    # Only ids and digests meet here: a payload that very many pages share costs no more than its rows.
    later = marks.join(first, "digest").filter("id IS NULL OR id <> first").select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct()
    joined = rows.join(later, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select("id", "url", "payload", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            path = f"part-{task:05d}-{number:05d}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([archive(held)], pa.binary())], ["path", "content"])

        for batch in batches:
            for i in range(batch.num_rows):
                key, uri, body, first = (batch.column(k)[i].as_py() for k in range(4))
                held.append(page_record(_name(key), uri, body, None if first is None else _name(first), date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield full()
                    number, held, size = number + 1, [], 0
        if held:
            yield full()

    return for_python(joined).mapInArrow(run, "path string, content binary")


def _name(key: int | None) -> str:
    return f"urn:page:{'none' if key is None else key}"


class BadRecord(ValueError):
    """A frame or record that breaks the format."""


def frames(content: memoryview) -> Iterator[tuple[int, bytes]]:
    """``(offset, record bytes)`` per frame; the dictionary is read from a leading skippable frame, other skippable frames are passed over."""
    pos, trained = 0, None
    while pos < len(content):
        if len(content) - pos < 8:
            raise BadRecord(f"{len(content) - pos} bytes after the last frame")
        magic, size = struct.unpack_from("<II", content, pos)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if len(content) - pos - 8 < size:
                raise BadRecord("skippable frame is cut off")
            if magic == DICTIONARY_FRAME and pos == 0:
                data = bytes(content[8:8 + size])
                if data[:4] == struct.pack("<I", FRAME):
                    data = zstandard.ZstdDecompressor().decompress(data, max_output_size=RECORD_BYTES)
                if data[:4] != struct.pack("<I", DICTIONARY):
                    raise BadRecord("the leading frame holds no dictionary")
                trained = zstandard.ZstdCompressionDict(data)
            pos += 8 + size
            continue
        if magic != FRAME:
            raise BadRecord("no frame")
        one = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
        stream, parts, at, total = one.decompressobj(), [], pos, 0
        while not stream.eof:
            if at >= len(content):
                raise BadRecord("frame is cut off")
            step = content[at:at + _STEP]
            try:
                parts.append(stream.decompress(step))
            except zstandard.ZstdError as e:
                raise BadRecord(f"frame cannot be decoded: {e}") from None
            total += len(parts[-1])
            if total > RECORD_BYTES:
                raise BadRecord("record is too large")
            at += len(step)
        at -= len(stream.unused_data)
        yield pos, b"".join(parts)
        pos = at


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#-'*+.^_`|~0-9A-Za-z-]+", name):
            raise BadRecord("header line is malformed")
        out.setdefault(name.decode().lower(), value.strip().decode("utf-8", "replace"))
    return out


def parse(data: bytes) -> dict:
    """The record in a frame: headers, HTTP headers and payload, all lengths and the payload's digest checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", first):
        raise BadRecord("no WARC header")
    fields = _fields(lines)
    for name in _REQUIRED:
        if name not in fields:
            raise BadRecord(f"{name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4:
        raise BadRecord(f"Content-Length is {fields['content-length']}, the block has {len(rest) - 4} bytes")
    if rest[-4:] != b"\r\n\r\n":
        raise BadRecord("the record does not end in two line ends")
    block, kind = rest[:-4], fields["warc-type"]
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        status, *lines = http.split(b"\r\n")
        if not gap or not re.match(rb"HTTP/\d\.\d \d{3}", status):
            raise BadRecord("no HTTP header")
        length = _fields(lines).get("content-length")
        size = len(payload)
        if length is not None:
            if not length.isdigit() or kind != "revisit" and int(length) != len(payload):
                raise BadRecord(f"the payload has {len(payload)} bytes, not {length}")
            size = int(length)
    digest = fields.get("warc-payload-digest")
    if digest and kind != "revisit" and digest.startswith("sha1:") and digest[5:] != base32_sha1(payload):
        raise BadRecord("the payload does not have its digest")
    if kind == "revisit" and "warc-refers-to" not in fields:
        raise BadRecord("a revisit refers to nothing")
    plain = lambda x: None if x is None else x.strip("<>")
    return {
        "record_id": plain(fields["warc-record-id"]), "record_type": kind, "date": fields["warc-date"], "target_uri": fields.get("warc-target-uri"),
        "payload_digest": None if digest is None else digest.partition(":")[2], "payload_bytes": size, "refers_to": plain(fields.get("warc-refers-to")),
        "payload": None if kind == "revisit" else payload,
    }


SCHEMA = (
    "path string, offset long, record_id string, record_type string, date string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to string, payload binary, error string"
)


def read_archives(archives: DataFrame, path: str = "path", content: str = "content", with_payload: bool = True) -> DataFrame:
    """A row per record of the archives, or per fault: then `error` says what is wrong and the other fields are null.

    A frame that cannot be decoded ends its archive, since the next one's start is unknown; a record that breaks the format does not.
    `payload_bytes` of a revisit is what its HTTP header says of the full payload.  Null content has no records.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows_of(where: str, data: bytes) -> Iterator[dict]:
        last = 0
        try:
            for offset, raw in frames(memoryview(data)):
                last = offset
                try:
                    got = parse(raw)
                    if not with_payload:
                        got["payload"] = None
                    yield {"path": where, "offset": offset, **got}
                except BadRecord as e:
                    yield {"path": where, "offset": offset, "error": str(e)}
        except BadRecord as e:
            yield {"path": where, "offset": last, "error": str(e)}

    kinds = pa.schema([(n, pa.int64() if n in ("offset", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, held, size = batch.column(1)[i].as_py(), [], 0
                for row in rows_of(batch.column(0)[i].as_py(), data or b""):
                    held.append(row)
                    size += len(row.get("payload") or b"") + 300
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    return archives.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content")).mapInArrow(run, SCHEMA)


def page_of(name: str) -> F.Column:
    """The page id in a record's name; null for the name of a null id."""
    return F.expr(f"try_cast(substring({name}, 10) AS BIGINT)")
