"""WARC archives with one zstandard frame per record and a dictionary in the file.

A file begins with a skippable frame (magic ``0x184D2A5D``) whose content is the dictionary;
every record follows as one zstandard frame coded with it, so a record can be read alone and
the file stays readable by any reader of the format.

The writer deduplicates: of records with equal payloads of at least ``MIN_SHARED`` bytes, the
one with the largest id is a ``response``, the others are ``revisit`` records that name it and
carry no payload; smaller payloads are always a ``response``.  Equal payloads are found by
SHA-1 digest and length, from narrow rows; the pages themselves meet the outcome by their ids.

The reader loads the dictionary from the leading skippable frame, decodes one frame per
record, and validates the version line, the required headers, the declared content length and
the payload digest.  What fails raises ``ValueError``.

Pages: a null payload is an empty one; null urls are written as an empty target.  Rows that
repeat an id and payload give repeated records; with a null id a page is never the response of
another, unless all equal pages have null ids (then all are responses).  An empty table gives
no file and no row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_files, stored, write_file

MIN_SHARED = 1_000
SUFFIX = ".warc.zst"
LEVEL = 3
#: Payload bytes in one file, about; a file is read by one task.
FILE_BYTES = 24_000_000
#: Bounds of the dictionary: its size, and the sampled pages and their bytes.
DICTIONARY_BYTES, SAMPLE_PAGES, SAMPLE_BYTES = 32_768, 256, 8_192

# Fixed values of the formats.
SKIPPABLE_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = bytes.fromhex("28b52ffd")
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")


# --------------------------------------------------------------------------- records

def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def build_record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """A response with its payload, or (with ``refers_to``) a revisit without it."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", "".join(c for c in url or "" if c >= " ")),
            ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
            ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to)),
                 ("WARC-Profile", REVISIT_PROFILE)]
    body = payload if refers_to is None else b""
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record; raises ``ValueError`` if it is not valid."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("not a WARC record of this version")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name in headers:
            raise ValueError(f"bad header line: {line[:80]!r}")
        headers[name] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            raise ValueError(f"missing header {name}")
    if not headers["Content-Length"].isdigit():
        raise ValueError("bad Content-Length")
    n = int(headers["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length differs from Content-Length")
    body = rest[:n]
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {kind}")
    if kind == "response" and "WARC-Payload-Digest" in headers:
        if headers["WARC-Payload-Digest"] != f"sha1:{hashlib.sha1(body).hexdigest()}":
            raise ValueError("the payload's digest differs from its header")
    if kind == "revisit" and ("WARC-Refers-To" not in headers or body):
        raise ValueError("a revisit must name its record and carry no payload")
    return headers, body


# --------------------------------------------------------------------------- archives

def dictionary_frame(content: bytes) -> bytes:
    return SKIPPABLE_MAGIC + len(content).to_bytes(4, "little") + content


def encode_archive(records, dictionary: bytes, level: int = LEVEL) -> Iterator[bytes]:
    """The parts of an archive: the dictionary frame, then one frame per record."""
    import zstandard as zstd
    coder = zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(dictionary)) if dictionary else (
        zstd.ZstdCompressor(level=level))
    yield dictionary_frame(dictionary)
    for record in records:
        yield coder.compress(record)


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one frame at a time."""
    import zstandard as zstd
    at, dictionary = 0, b""
    if data[:4] == SKIPPABLE_MAGIC:
        if len(data) < 8 or len(data) < (at := 8 + int.from_bytes(data[4:8], "little")):
            raise ValueError("the dictionary frame is cut short")
        dictionary = bytes(data[8:at])
        if dictionary[:4] == FRAME_MAGIC:
            dictionary = zstd.ZstdDecompressor().decompress(dictionary)
    coder = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary)) if dictionary else zstd.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        if data[at:at + 4] != FRAME_MAGIC:
            raise ValueError(f"no zstandard frame at byte {at}")
        try:
            frame = coder.decompressobj()
            # The frame's end is not known before it is decoded: feed it in growing steps.
            parts, fed, step = [], at, 4_096
            while not frame.eof:
                if fed >= len(data):
                    raise ValueError("the last record's frame is cut short")
                parts.append(frame.decompress(view[fed:fed + step]))
                fed, step = min(len(data), fed + step), step * 2
        except zstd.ZstdError as e:
            raise ValueError(f"bad frame at byte {at}: {e}") from e
        at = fed - len(frame.unused_data)
        yield parse_record(b"".join(parts))


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the samples; empty if they are too few to train one."""
    import zstandard as zstd
    if len(samples) < 16 or sum(map(len, samples)) < 8 * 1_024:
        return b""
    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b""


# --------------------------------------------------------------------------- tables

def page_sample(pages: DataFrame, id_col: str, payload_col: str) -> list[bytes]:
    """Openings of at most ``SAMPLE_PAGES`` pages, those with the smallest id hash per slot."""
    slot = F.pmod(F.xxhash64(F.col(id_col)), F.lit(SAMPLE_PAGES))
    rows = pages.where(F.col(payload_col).isNotNull()).select(
        slot.alias("slot"), F.xxhash64(F.lit(3), F.col(id_col)).alias("h"),
        F.substring(F.col(payload_col), 1, SAMPLE_BYTES).alias("opening"))
    rows = rows.groupBy("slot").agg(F.min(F.struct("h", "opening")).alias("m")).orderBy("slot")
    return [build_record(None, "", (r[0] or "").encode("utf-8")) for r in rows.select("m.opening").collect()]


def revisits(rows: DataFrame) -> DataFrame:
    """``(k, digest, refers_to)`` of the pages that revisit another, from ``(id, k, digest,
    size)`` with a null digest for small payloads."""
    rows = stored(rows.where("digest is not null"), "warc-digests")
    shared = rows.groupBy("digest", "size").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where("n > 1 and response is not null").select("digest", "size", "response"), "warc-shared")
    found = rows.join(shared, ["digest", "size"]).where(~F.col("response").eqNullSafe(F.col("id")))
    return found.groupBy("k", "digest").agg(F.max("response").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page; returns ``(shard, file, records, bytes)``."""
    dictionary = train_dictionary(page_sample(pages, id_col, payload_col))
    text = F.col(payload_col)
    key = [F.xxhash64(id_col).alias("k"), F.when(F.octet_length(text) >= MIN_SHARED, F.unhex(F.sha1(text.cast("binary")))).alias("digest")]
    again = stored(revisits(pages.select(F.col(id_col).alias("id"), *key, F.octet_length(text).alias("size"))), "warc-revisits")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text.alias("payload"), *key)
    # By id and digest: a payload that many pages share is spread over all tasks.
    rows = rows.join(again.hint("merge"), ["k", "digest"], "left").select("id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        out, records, size = [], [], 0

        def close():
            nonlocal records, size
            name = f"part-{shard:06d}-{len(out):06d}{SUFFIX}"
            n = write_file(folder, name, encode_archive(records, dictionary))
            out.append((shard, len(out), len(records), n))
            records, size = [], 0

        for batch in batches:
            for page, url, payload, refers in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                records.append(build_record(page, url, (payload or "").encode("utf-8"), refers))
                size += len(records[-1])
                if size >= file_bytes:
                    close()
        if records:
            close()
        cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(cols, ["shard", "file", "records", "bytes"])

    return stored(rows.mapInArrow(run, "shard long, file long, records long, bytes long"), "warc-written")


def read_archives(files: DataFrame) -> DataFrame:
    """A row per record: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload`` (null for revisits).  ``payload_bytes`` and the digest are of the full payload."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])

    def row(headers: dict[str, str], body: bytes) -> tuple:
        kind = headers["WARC-Type"]
        number = lambda name: int(headers[name]) if name in headers else None
        digest = headers["WARC-Payload-Digest"].partition(":")[2]
        return (number("X-Page-ID"), headers.get("WARC-Target-URI"), kind, number("X-Refers-To-Page-ID"),
                number("X-Payload-Length"), digest, body if kind == "response" else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1):
                rows, size = [], 0
                for headers, body in read_archive(data.as_py()):
                    rows.append(row(headers, body))
                    size += len(body)
                    if size > 8_000_000 or len(rows) >= 2_000:
                        yield _table(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield _table(rows, schema)

    return files.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, "
                                 "payload_bytes long, payload_digest string, payload binary")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                      schema=schema)


def open_archives(spark, folder: str) -> DataFrame:
    return read_files(spark, folder, SUFFIX)
