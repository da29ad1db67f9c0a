"""WARC archives in Zstandard: a writer, and a reader that decodes one frame per record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the archive's dictionary, itself compressed.
Each record is one frame, compressed with that dictionary, so records can be decoded one at a time in bounded memory.
The dictionary is trained on the first records of the archive, at most ``TRAIN_BYTES`` of them.

The reader loads the dictionary from the leading skippable frame if there is one, streams the frames, and checks of each
record: the version line, the mandatory fields, that the block has Content-Length bytes and is followed by the two line
ends that close a record and nothing else, and, for responses, that the payload has the digest and length announced.

Archives lie in a folder that all executors share, and are read and written through ``pyarrow.fs``, so any store it
knows will do. A task writes each archive under a name of its own attempt and reports it only when it is complete;
the table of reports is what the reader reads, so archives of lost or repeated attempts are never seen.

Of records with equal payloads the one with the largest page_id is the response and the others revisit it. Defined
results: a null html is an empty payload. Rows that repeat the largest page_id and the payload are responses too, since
they cannot refer to themselves; null ids are the smallest, and a group of null ids only is all responses. Null urls are
empty; characters that headers cannot hold are percent-encoded. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from functools import partial
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from posledger.llm.common import text_of
from posledger.sources.tables import shared_folder, stage

DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TRAIN_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
CHUNK = 1 << 18
BATCH = 500
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2024-01-01T00:00:00Z"

WRITTEN = "path string, records long, bytes long"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "payload binary, problem string")
RECORDS_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])


class BadRecord(ValueError):
    """A frame that is no valid record."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{0,19})>", urn)
    if not found or found[1] == "-":
        raise BadRecord(f"record id {urn[:60]!r}")
    return int(found[1]) if found[1] else None


# writing ------------------------------------------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the payload's HTTP header, digest and length but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~-._ ")),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        fields[4:4] = [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame and its dictionary; nothing if the samples are too few to train one."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
    except zstandard.ZstdError:
        return b"", None
    body = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body, trained


def _open(path: str):
    return pa.fs.FileSystem.from_uri(path)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = _open(folder)

    def records():
        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*batch.columns):
                yield record(page_id.as_py(), url.as_py(), html.as_py(), refers_to.as_py(), revisit.as_py())

    def archive(source) -> tuple[str, int, int] | None:
        first, size = [], 0
        for r in source:
            first.append(r)
            size += len(r)
            if size >= TRAIN_BYTES:
                break
        if not first:
            return None
        frame, dictionary = dictionary_frame(first)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        name, count, size = f"{uuid.uuid4().hex}.warc.zst", 0, len(frame)
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(frame)
            for r in chain(first, source):
                packed = compressor.compress(r)
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= ARCHIVE_BYTES and count >= len(first):
                    break
        return f"{folder}/{name}", count, size

    source = records()
    while done := archive(source):
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "records", "bytes"), done))], pa.schema(
            [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): which records respond and which revisit."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        text_of(html).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    shared = rows.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null")
    shared = stage(shared.drop("n"), "warc-shared-payloads")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return rows.join(shared, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "refers_to", revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Write a record per row; gives the table (path, records, bytes) of the complete archives."""
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    plan = plan_records(pages, page_id, url, html, min_bytes)
    return stage(plan.mapInArrow(partial(_write, folder=folder), WRITTEN), "warc-archives")


# reading ------------------------------------------------------------------------------------------------------

def _dictionary(stream) -> tuple[zstandard.ZstdCompressionDict | None, bytes, BadRecord | None]:
    """The dictionary of a leading skippable frame, what was read beyond it, and what is wrong with it."""
    data = stream.read(8)
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != DICTIONARY_MAGIC:
        return None, data, None
    body = stream.read(struct.unpack("<I", data[4:])[0])
    if len(body) < struct.unpack("<I", data[4:])[0]:
        return None, b"", BadRecord("the dictionary frame is cut short")
    try:
        if body[:4] == zstandard.FRAME_HEADER:
            body = zstandard.ZstdDecompressor().decompress(body)
        return zstandard.ZstdCompressionDict(body), b"", None
    except zstandard.ZstdError as error:
        return None, b"", BadRecord(f"dictionary: {error}")


def frames(stream) -> Iterator[bytes | BadRecord]:
    """Decoded frames of an archive, with the dictionary of its leading skippable frame.

    A frame that cannot be decoded gives its problem instead, and reading goes on at the next frame header after its
    start, so the records behind a damaged one are not lost. Without its dictionary an archive gives problems only.
    """
    dictionary, data, problem = _dictionary(stream)
    if problem:
        yield problem
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        while len(data) < 8 and (more := stream.read(CHUNK)):
            data += more
        if not data:
            return
        if data[1:4] == b"\x2a\x4d\x18" and data[0] & 0xF0 == 0x50:  # other skippable frames
            size = 8 + struct.unpack("<I", data[4:8])[0] if len(data) >= 8 else 8
            while len(data) < size and (more := stream.read(CHUNK)):
                data += more
            if len(data) < size:
                yield BadRecord("a skippable frame is cut short")
                return
            data = data[size:]
            continue
        frame, parts, raw, chunk, problem = decompressor.decompressobj(), [], bytearray(data), data, None
        while not frame.eof:
            try:
                parts.append(frame.decompress(chunk))
            except zstandard.ZstdError as error:
                problem = BadRecord(f"frame: {error}")
                break
            if not frame.eof:
                chunk = stream.read(CHUNK)
                raw += chunk
                if not chunk:
                    problem = BadRecord("the last frame is cut short")
                    break
        if problem is None:
            data = frame.unused_data
            yield b"".join(parts)
            continue
        yield problem
        at = raw.find(zstandard.FRAME_HEADER, 4)
        while at < 0:
            more = stream.read(CHUNK)
            if not more:
                return
            raw = raw[-3:] + more
            at = raw.find(zstandard.FRAME_HEADER)
        data = bytes(raw[at:])


def parse(frame: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the one record of a frame, validated."""
    head, gap, rest = frame.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        raise BadRecord(f"version line {lines[0][:40]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name.strip():
            raise BadRecord(f"header line {line[:40]!r}")
        fields[name.strip()] = value.strip()
    missing = [n for n in REQUIRED if n not in fields]
    if missing:
        raise BadRecord(f"missing {', '.join(missing)}")
    if not fields["Content-Length"].isdigit():
        raise BadRecord(f"Content-Length {fields['Content-Length']!r}")
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadRecord(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    return fields, rest[:size]


def http_payload(block: bytes) -> tuple[int, bytes]:
    """The length that the HTTP header announces, and the body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise BadRecord("no HTTP header")
    sizes = [v for n, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if n.lower() == b"content-length"]
    if not sizes or not sizes[0].strip().isdigit():
        raise BadRecord("no HTTP length")
    return int(sizes[0]), body


def read_record(frame: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, problem)."""
    fields, block = parse(frame)
    kind = fields["WARC-Type"]
    size, payload = http_payload(block)
    digest = fields.get("WARC-Payload-Digest", "")
    if not digest.startswith("sha1:"):
        raise BadRecord("no payload digest")
    refers_to = None
    if kind == "revisit":
        refers_to = _page(fields.get("WARC-Refers-To", ""))
    elif len(payload) != size or digest_of(payload) != digest[5:]:
        raise BadRecord("the payload is not what its length or digest says")
    return (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, refers_to, size, digest[5:],
            payload if kind != "revisit" else None, None)


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(RECORDS_ARROW)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RECORDS_ARROW)],
                                          schema=RECORDS_ARROW)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, root = _open(path)
            with store.open_input_stream(root, compression=None) as stream:
                for frame in frames(stream):
                    try:
                        if isinstance(frame, BadRecord):
                            raise frame
                        row = read_record(frame)
                    except BadRecord as error:
                        row = (*[None] * 7, f"{path}: {error}")
                    rows.append(row if payloads else (*row[:6], None, row[7]))
                    held += len(row[6] or b"") if payloads else 0
                    if len(rows) >= BATCH or held >= 16 << 20:
                        yield flushed()
                        held = 0
    yield flushed()


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives in column ``path``. A record that fails a check has only its ``problem``."""
    paths = archives.select("path")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return paths.repartition(tasks).mapInArrow(partial(_read, payloads=payloads), RECORDS)


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared folder, as a URI."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
