"""Web archives: written with revisit records, read back with salvage.

Every record is a gzip member of its own. Of records with equal payloads of at
least :data:`LEAST_REVISIT` bytes the one with the smallest page_id is a
response; the others are revisits that name it and repeat only its HTTP header.

The reader checks each member (gzip checksum, version line, length, digests).
After a failure it seeks the next place where a member or, in plain archives, a
version line begins and a record can be read, goes on there, and logs the bytes
between as a quarantined gap. It holds one record at a time.

Cases: a null html is an empty payload; a null page_id is written without that
header and is never referred to by others with one; rows that repeat the
smallest page_id and its payload are all responses; a header may have any length
(a very long url), and is held whole like the rest of its record; line breaks in a URL are
percent-encoded in the archive and restored; an empty table gives no archive.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, prepare, remote
from tidemark.llm.files import locate, remove_unfinished, shared_folder, whole_file
from tidemark.session import materialize

LEAST_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the archive format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MARK = b"\x1f\x8b\x08"
VERSION_MARK = b"WARC/1."

CHUNK = 1 << 20

_SPACE = uuid.UUID("6f1c0f3e-8f0e-4c1e-9a51-5a3f0d2b7c11")


class Damaged(Exception):
    """A record that fails a check."""


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record's bytes, before compression; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest) if refers_to is None else record_id(page_id, "revisit " + digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else re.sub("[\r\n%]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "X-Page-Id": page_id,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["WARC-Refers-To"] = record_id(refers_to, digest)
        fields["X-Refers-To-Page-Id"] = refers_to
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member, the same bytes whenever it is made."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Window:
    """Reads anywhere in a file, a chunk at a time."""

    def __init__(self, file) -> None:
        self.file, self.size = file, file.size()
        self.at, self.held = 0, b""

    def read(self, begin: int, count: int) -> bytes:
        if begin < self.at or begin + count > self.at + len(self.held):
            self.file.seek(begin)
            self.at, self.held = begin, self.file.read(max(count, CHUNK))
        return self.held[begin - self.at : begin - self.at + count]

    def find(self, begin: int) -> int:
        """The next place at or after ``begin`` where a record may begin, or the end."""
        while begin < self.size:
            part = self.read(begin, CHUNK)
            found = [at for at in (part.find(GZIP_MARK), part.find(VERSION_MARK)) if at >= 0]
            if found:
                return begin + min(found)
            if begin + len(part) >= self.size:
                break
            begin += len(part) - len(VERSION_MARK)
        return self.size


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields (names lower-cased), block and length of the record data begins with."""
    head_end = data.find(b"\r\n\r\n")
    if not data.startswith(VERSION_MARK) or head_end < 0:
        raise Damaged("no header")
    try:
        lines = data[:head_end].decode().split("\r\n")[1:]
        fields = {name.lower(): value.strip() for name, value in (line.split(":", 1) for line in lines)}
        length = int(fields["content-length"])
    except (ValueError, KeyError) as error:
        raise Damaged(f"bad header: {error}") from error
    begin = head_end + 4
    block = data[begin : begin + length]
    if length < 0 or len(block) < length or data[begin + length : begin + length + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    named = fields.get("warc-block-digest", "")
    if named.startswith("sha256:") and hashlib.sha256(block).hexdigest() != named[7:]:
        raise Damaged("wrong block digest")
    return fields, block, begin + length + 4


def _member(window: _Window, begin: int) -> tuple[bytes, int]:
    """The data of the gzip member at ``begin`` and where it ends."""
    unpacker, out, at = zlib.decompressobj(31), [], begin
    while not unpacker.eof:
        part = window.read(at, CHUNK)
        if not part:
            raise Damaged("the file ends in a member")
        try:
            out.append(unpacker.decompress(part))
        except zlib.error as error:
            raise Damaged(f"bad member: {error}") from error
        at += len(part)
    return b"".join(out), at - len(unpacker.unused_data)


def _plain(window: _Window, begin: int) -> tuple[bytes, int]:
    """The data of the uncompressed record at ``begin``."""
    count, end = CHUNK, -1
    while end < 0 and count < 2 * max(CHUNK, window.size - begin):
        head = window.read(begin, count)
        end = head.find(b"\r\n\r\n")
        count *= 2
    named = re.search(rb"(?i)\r\ncontent-length:\s*(\d{1,18})\s*(?:\r\n|$)", head[: max(end, 0)])
    if end < 0 or named is None:
        raise Damaged("no header")
    size = end + 4 + int(named[1]) + 4
    if begin + size > window.size:
        raise Damaged("wrong length")
    return window.read(begin, size), begin + size


def salvage(file) -> Iterator[tuple[str, int, int, object]]:
    """Of an open file: ("record", begin, end, (fields, block)) and ("gap", begin, end, reason)."""
    window = _Window(file)
    at, lost, reason = 0, None, ""
    while at < window.size:
        try:
            begins = window.read(at, len(VERSION_MARK))
            if begins.startswith(GZIP_MARK):
                data, end = _member(window, at)
            elif begins == VERSION_MARK:
                data, end = _plain(window, at)
            else:
                raise Damaged("neither a member nor a version line")
            fields, block, length = parse(data)
            if length != len(data):
                raise Damaged("bytes after the record")
        except Damaged as error:
            if lost is None:
                lost, reason = at, str(error)
            at = window.find(at + 1)
            continue
        if lost is not None:
            yield "gap", lost, at, reason
            lost = None
        yield "record", at, end, (fields, block)
        at = end
    if lost is not None:
        yield "gap", lost, window.size, reason


def _write(batches, folder: str):
    task, written = TaskContext.get().partitionId(), 0
    held: list[bytes] = []
    size = 0

    def close() -> pa.RecordBatch:
        path = f"{folder}/pages-{task:06d}-{written:06d}.warc.gz"
        with whole_file(path) as stream:
            for part in held:
                stream.write(part)
        return pa.RecordBatch.from_pydict({"path": [path], "records": [len(held)], "bytes": [size]})

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
            page_id, url, html, digest, refers_to = row
            held.append(member(record(page_id, url, (html or "").encode(), digest, refers_to)))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield close()
                held, size, written = [], 0, written + 1
    if held:
        yield close()


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, and refers_to: the page whose payload is repeated, or null."""
    own = own_columns(pages, page_id="long", url="string", html="string")
    own = own.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    repeated = (
        own.where(F.octet_length("html") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "least")
    )
    return own.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per page below ``folder``; returns path, records and bytes of each archive."""
    prepare(pages.sparkSession)
    manifest = with_references(pages).mapInArrow(
        remote(_write, folder), "path string, records long, bytes long"
    )
    manifest = materialize(manifest, "archives")
    remove_unfinished(pages.sparkSession, folder)
    return manifest


READ = (
    "path string, begin long, stop long, problem string, page_id long, url string, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, payload binary"
)


def _row(fields: dict[str, str], block: bytes) -> dict:
    kind = fields.get("warc-type")
    head, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    named = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
    url = fields.get("warc-target-uri")
    if kind == "revisit":
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        length = int(named[1]) if named else None
        payload = None
    else:
        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
        stated = fields.get("warc-payload-digest", "")
        if stated.startswith("sha256:") and stated[7:] != digest:
            raise Damaged("wrong payload digest")
    return {
        "page_id": number("x-page-id"),
        "url": None if url is None else re.sub("%(0A|0D|25)", lambda m: chr(int(m[1], 16)), url),
        "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": number("x-refers-to-page-id"), "payload": payload,
    }


def _read(batches, payloads: bool):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, place = locate(path)
            rows, size = [], 0
            with store.open_input_file(place) as file:
                for kind, begin, stop, what in salvage(file):
                    row = {"path": path, "begin": begin, "stop": stop}
                    if kind == "gap":
                        row["problem"] = what
                    else:
                        try:
                            row |= _row(*what)
                        except (Damaged, ValueError) as error:
                            row["problem"] = str(error)
                    if not payloads:
                        row.pop("payload", None)
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"") + len(row.get("url") or "")
                    if size >= CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)


_READ = pa.schema(
    [
        ("path", pa.string()), ("begin", pa.int64()), ("stop", pa.int64()), ("problem", pa.string()),
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives named in column ``path``, and their gaps.

    A row with ``problem`` is a quarantined byte range, or a sound record of
    unsound content. Archives are read in parallel, each by one task.
    """
    prepare(archives.sparkSession)
    return (
        archives.select("path")
        .repartition(partitions(archives.sparkSession), "path")
        .mapInArrow(remote(_read, payloads), READ)
    )


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to new archives in the shared folder and read them back, without payloads."""
    return read_archives(write_archives(pages, shared_folder(spark, "warc")), payloads=False)
