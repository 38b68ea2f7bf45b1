"""WARC archives: one gzip member per record, and a reader that splits files at any byte.

A task of the reader gets a byte range. It looks for gzip's magic bytes, decodes the
start of each candidate and takes it as a member only if a WARC header comes out. It owns the
records that start in its range and reads the last one past the end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import Files, by_batches, folder, keep, partitions

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 16
#: Bytes of an archive that one reading task owns.
SPLIT = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture


def record_id(page_id: int | None) -> str:
    """A version 8 UUID that holds the page id."""
    raw = (page_id or 0) & (1 << 64) - 1
    value = (raw >> 16) << 80 | 8 << 76 | (page_id is None) << 64 | 2 << 62 | raw & 0xFFFF
    return f"<{uuid.UUID(int=value).urn}>"


def page_of(record: str) -> int | None:
    value = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 64 & 1:
        return None
    raw = (value >> 80) << 16 | value & 0xFFFF
    return raw - (1 << 64) if raw >> 63 else raw


def digest_of(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """A whole record. payload None: a revisit, whose HTTP header keeps the size of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        name = f"{uuid.uuid4().hex}.warc.gz"

        def fill(out: pa.NativeFile) -> None:
            batch = first
            while batch is not None:
                for row in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html", "size", "sha", "refers_to"))):
                    page_id, url, html, size, sha, refers_to = row
                    payload = None if html is None else html.encode()
                    out.write(_member(record(page_id, url, payload, size, digest_of(bytes.fromhex(sha)), refers_to)))
                batch = next(batches, None)

        size = Files(uri).write(name, fill)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())], ["name", "bytes"])

    return run


def write_archive(pages: DataFrame, uri: str | None = None, smallest: int = 0) -> tuple[str, DataFrame]:
    """Write a record per row of pages (page_id, url, html); return the folder and (name, bytes) per file.

    Of records with equal payloads of at least ``smallest`` bytes, that with the largest page_id is
    the response, the others revisit it. Null html: empty payload. Null url: no target. Null
    page ids revisit another page, or are a response if their group has no id. Repeated rows with the
    largest id are all responses. No rows: no files.
    """
    uri = uri or folder(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.octet_length(html).cast("long").alias("size"), F.sha1(html).alias("sha"))
    holders = keep(rows.where(F.col("size") >= smallest).groupBy("sha").agg(F.max("page_id").alias("holder")))
    rows = rows.join(holders, "sha", "left")
    own = F.col("holder").isNull() | F.coalesce(F.col("page_id") == F.col("holder"), F.lit(False))
    rows = rows.select(
        "page_id",
        "url",
        F.when(own, F.coalesce("html", F.lit(""))).alias("html"),
        "size",
        "sha",
        F.when(~own, F.col("holder")).alias("refers_to"),
    )
    return uri, keep(by_batches(rows, _writer(uri), "name string, bytes long"))


class _Inflated:
    """The bytes of one gzip member of a file, in chunks of bounded size."""

    def __init__(self, file: pa.NativeFile, at: int):
        self.file, self.read_to, self.end = file, at, None
        self.unpacker, self.waiting = zlib.decompressobj(31), b""

    def more(self) -> bytes:
        """The next bytes; none at the end of the member, whose place is then known."""
        while self.end is None:
            if not self.waiting:
                self.file.seek(self.read_to)
                self.waiting = self.file.read(CHUNK)
                self.read_to += len(self.waiting)
                if not self.waiting:
                    raise zlib.error("the file ends inside a member")
            out = self.unpacker.decompress(self.waiting, 1 << 20)
            self.waiting = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.end = self.read_to - len(self.unpacker.unused_data)
            if out:
                return out
        return b""


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _header(member: _Inflated) -> tuple[dict[str, str], bytes] | None:
    """Header fields and what follows of the data; None if this is no WARC record."""
    data = b""
    try:
        while b"\r\n\r\n" not in data:
            more = member.more()
            data += more
            if not more or not data.startswith(b"WARC/"[: len(data)]):
                return None
    except zlib.error:
        return None
    head, _, rest = data.partition(b"\r\n\r\n")
    return _fields(head), rest


def records(file: pa.NativeFile, begin: int, end: int, payloads: bool = False) -> Iterator[dict]:
    """Records whose members start in [begin, end)."""
    at, known = begin, False
    while at < end:
        if not known:  # look for the magic; it may lie across the end of what is read
            file.seek(at)
            window = file.read(min(CHUNK, end - at + len(MAGIC) - 1))
            hit = window.find(MAGIC)
            if hit < 0:
                at += max(1, len(window) - len(MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
        member = _Inflated(file, at)
        found = _header(member)
        if found is None:
            at, known = at + 1, False
            continue
        fields, rest = found
        length, block = int(fields["content-length"]), rest
        while b"\r\n\r\n" not in block and (more := member.more()):
            block += more
        http, _, body = block.partition(b"\r\n\r\n")
        left = length - len(http) - 4
        sha, kept, held = hashlib.sha1(), [], 0
        while True:
            body = body[: left - held]
            sha.update(body)
            held += len(body)
            if payloads:
                kept.append(body)
            if not (body := member.more()):
                break
        response = fields["warc-type"] == "response"
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        yield {
            "page_id": page_of(fields["warc-record-id"]),
            "payload_bytes": held if response else int(_fields(http)["content-length"]),
            "payload_digest": digest_of(sha.digest()) if response else stated,
            "record_type": fields["warc-type"],
            "refers_to": None if response else page_of(fields["warc-refers-to"]),
            "intact": held == left and (not response or digest_of(sha.digest()) == stated),
            "url": fields.get("warc-target-uri"),
        } | ({"payload": b"".join(kept)} if payloads else {})
        at, known = member.end, True


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean, url string"


def _reader(uri: str, payloads: bool):
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())]
    kinds += [("refers_to", pa.int64()), ("intact", pa.bool_()), ("url", pa.string())] + ([("payload", pa.binary())] if payloads else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(uri)
        for batch in batches:
            for r in batch.to_pylist():
                with files.open(r["name"]) as file:
                    rows, size = [], 0
                    for found in records(file, r["begin"], r["end"], payloads):
                        rows.append(found)
                        size += found["payload_bytes"] if payloads else 200
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    return run


def read_archive(uri: str, files: DataFrame, split: int = SPLIT, payloads: bool = False) -> DataFrame:
    """Records of the archives (name, bytes): page_id, payload_bytes, payload_digest, record_type,
    refers_to, intact (the digest fits the payload), url, and payload (binary) if asked for.

    Payload size and digest of a revisit are those of the full payload, from its headers.
    Files are cut into ranges of ``split`` bytes, each read by one task.
    """
    ranges = files.where("bytes > 0").select("name", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split}L)")).alias("begin"))
    ranges = ranges.select("name", "begin", F.least(F.col("begin") + split, F.col("bytes")).alias("end"))
    ranges = ranges.repartition(partitions(files.sparkSession), "name", "begin")
    return by_batches(ranges, _reader(uri, payloads), SCHEMA + (", payload binary" if payloads else ""))


def archived(pages: DataFrame) -> DataFrame:
    """Write pages as WARC and read every record back. Cases as in ``write_archive``."""
    uri, files = write_archive(pages)
    return read_archive(uri, files)
