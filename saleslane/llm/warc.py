"""WARC archives: pages written one gzip member per record, and a sequential reader.

``write`` gives every page a record.  Of pages with equal payloads of at least ``min_revisit`` bytes
the one with the largest id is a response and the others are revisits, which name it and hold the
HTTP header without the payload.  Each task writes its rows to archives of bounded size in a shared
folder, under names that no other attempt of the task uses.  The result is the list of the archives
of successful attempts, one row each; what a lost attempt left behind is in no list and never read.

``read`` opens one archive per row of such a list and goes through it once from its start: members
are decompressed step by step with bounded output, headers end at an empty line, blocks are framed
by their Content-Length, and block and payload digests are computed while the bytes pass and are
compared with the header.  Without ``payload`` no record is held as a whole, whatever its size.

Equal payloads are found by partial aggregation of their digests, and pages meet the groups of two
or more in a join whose small side adaptive execution measures; a payload that a third of all pages
share adds one row to it.

Cases: a null html is an empty payload and a null url is left out of the header.  Pages without an id
are never referred to: a group without any id holds only responses.  Rows that repeat the largest
id are all responses.  Control characters, blanks and per cent signs of a url are percent-encoded.
Extra columns are ignored.  An empty table gives no archives and no records.  A record that is cut
off, wrongly framed or whose digest differs raises an error; with ``strict=False`` it becomes a row
whose ``error`` says so, and reading goes on at the next member, or ends if there is none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm.blocks import in_parts
from saleslane.plans.durable import checkpoint_dir, durable

#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes read, and bytes decompressed, at a time.
READ_BYTES = 1 << 18
#: A header, WARC or HTTP, of more bytes is taken for a broken record.
HEADER_BYTES = 1 << 20
_BATCH_BYTES = 4 << 20
_BATCH_ROWS = 1024

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_WBITS = 16 + zlib.MAX_WBITS

FILES_SCHEMA = "archive string, n_records long, n_bytes long"
RECORDS_SCHEMA = (
    "archive string, offset long, record_type string, page_id {0}, refers_to {0}, url string, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path inside it."""
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def _digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(raw).decode()


def _record_id(page: object) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


_UNSAFE = re.compile(rb"[\x00-\x20\x7f%]")


def record(page: object, url: bytes | None, payload: bytes, refers_to: object = None) -> bytes:
    """The plain bytes of a response, or of a revisit if it refers to another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", _digest(hashlib.sha1(block).digest())),
        ("WARC-Payload-Digest", _digest(hashlib.sha1(payload).digest())),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url).decode("utf-8", "surrogateescape")))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogateescape") for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(plain: bytes, level: int = 6) -> bytes:
    """One gzip member; equal bytes give equal members."""
    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP_WBITS)
    return packer.compress(plain) + packer.flush()


class _Archives:
    """The archives of one attempt of a task: a file is opened, filled, closed and reported."""

    def __init__(self, folder: str, part: int, limit: int):
        self.system, self.folder = _place(folder)
        self.shown, self.part, self.limit = folder, part, limit
        self.attempt, self.stream = uuid.uuid4().hex[:12], None
        self.number = self.records = self.size = 0

    def add(self, packed: bytes) -> Iterator[tuple[str, int, int]]:
        if self.stream is None:
            self.name = f"part-{self.part:06d}-{self.number:05d}-{self.attempt}.warc.gz"
            self.stream = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        self.stream.write(packed)
        self.records, self.size = self.records + 1, self.size + len(packed)
        if self.size >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[tuple[str, int, int]]:
        if self.stream is None:
            return
        self.stream.close()
        yield f"{self.shown}/{self.name}", self.records, self.size
        self.stream, self.number, self.records, self.size = None, self.number + 1, 0, 0


def _with_targets(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url and html as bytes, and refers_to: the page that a revisit names, else null."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", F.col("url").cast("binary").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_revisit, F.sha1("html")))
    groups = (
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, min_revisit: int = 1000, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) to archives; rows (archive, n_records, n_bytes).

    The archives are written once, now; ``folder`` must be reachable by all executors.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    system, inside = _place(folder)
    system.create_dir(inside, recursive=True)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, done = _Archives(folder, TaskContext.get().partitionId(), archive_bytes), []
        for batch in in_parts(batches):
            for row in batch.to_pylist():
                plain = record(row["page_id"], row["url"], row["html"], row["refers_to"])
                done += archives.add(member(plain))
        done += archives.close()
        columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=False)]
        if done:
            yield pa.RecordBatch.from_arrays(columns, names=["archive", "n_records", "n_bytes"])

    return durable(_with_targets(pages, min_revisit).mapInArrow(written, FILES_SCHEMA))


class BrokenRecord(ValueError):
    """A record that is cut off, wrongly framed or does not match its digest."""


class _Members:
    """The gzip members of a stream, each decompressed in steps of bounded size."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.at = stream, b"", 0

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(READ_BYTES)
        return bool(self.raw)

    def begin(self) -> bool:
        """Go to the next member, if there is one; ``at`` is its offset."""
        if not self._more():
            return False
        self.unpacker, self.buffer = zlib.decompressobj(GZIP_WBITS), b""
        self.start = self.at
        return True

    def step(self) -> bytes:
        """Some more bytes of this member; none at its end."""
        while not self.unpacker.eof:
            if not self._more():
                raise BrokenRecord("the last member is cut off")
            before = len(self.raw)
            try:
                out = self.unpacker.decompress(self.raw, READ_BYTES)
            except zlib.error as error:
                raise BrokenRecord(str(error)) from None
            self.raw = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            self.at += before - len(self.raw)
            if out:
                return out
        return b""

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in pieces."""
        while n:
            piece = self.buffer or self.step()
            if not piece:
                raise BrokenRecord("the member ends inside its record")
            self.buffer, piece = piece[n:], piece[:n]
            n -= len(piece)
            yield piece

    def head(self, limit: int) -> bytes:
        """All up to and with the next empty line, of at most ``limit`` bytes."""
        found = self.buffer
        while (end := found.find(b"\r\n\r\n")) < 0:
            piece = self.step() if len(found) <= limit else b""
            if not piece:
                raise BrokenRecord("a header has no end")
            found += piece
        end += 4
        if end > limit:
            raise BrokenRecord("a header has no end")
        self.buffer = found[end:]
        return found[:end]

    def skip(self) -> bool:
        """Leave the member; whether the stream can be read on after it."""
        self.buffer = b""
        try:
            while self.step():
                pass
        except BrokenRecord:
            return False
        return True


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(fields: dict[str, str]) -> int:
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise BrokenRecord("a header has no length")
    return int(fields["content-length"])


def _page(fields: dict[str, str], name: str) -> int | str | None:
    found = re.fullmatch(r"<urn:x-page:(.*)>", fields.get(name, ""), re.DOTALL)
    return found[1] if found and found[1] else None


def _read_record(members: _Members, payload: bool) -> dict:
    """The record of the present member, checked."""
    head = members.head(HEADER_BYTES)
    if not head.startswith(VERSION + b"\r\n"):
        raise BrokenRecord("the member does not start with a record")
    fields = _fields(head)
    left = _length(fields)
    http = members.head(min(left, HEADER_BYTES))
    block, body = hashlib.sha1(http), hashlib.sha1()
    pieces, size = [], 0
    for piece in members.take(left - len(http)):
        block.update(piece)
        body.update(piece)
        size += len(piece)
        if payload:
            pieces.append(piece)
    if b"".join(members.take(4)) != b"\r\n\r\n" or members.buffer or members.step():
        raise BrokenRecord("the record does not end where its length says")
    if fields.get("warc-block-digest", "") != _digest(block.digest()):
        raise BrokenRecord("the block does not match its digest")
    revisit = fields.get("warc-type") == "revisit"
    stated, full = fields.get("warc-payload-digest", ""), _length(_fields(http))
    if not revisit and (stated != _digest(body.digest()) or size != full):
        raise BrokenRecord("the payload does not match its digest")
    url = fields.get("warc-target-uri")
    return {
        "record_type": fields.get("warc-type"),
        "page_id": _page(fields, "warc-record-id"),
        "refers_to": _page(fields, "warc-refers-to"),
        "url": None if url is None else unquote_to_bytes(url.encode("utf-8", "surrogateescape")).decode("utf-8", "replace"),
        "payload_bytes": full,
        "payload_digest": base64.b32decode(stated.removeprefix("sha1:")).hex(),
        "payload": None if revisit or not payload else b"".join(pieces),
    }


def records_of(stream: BinaryIO, payload: bool = True, strict: bool = True) -> Iterator[dict]:
    """The records of one archive, in order, each with its offset."""
    members = _Members(stream)
    while members.begin():
        at = members.start
        try:
            yield {"offset": at, "error": None, **_read_record(members, payload)}
        except BrokenRecord as broken:
            if strict:
                raise BrokenRecord(f"record at {at}: {broken}") from None
            yield {"offset": at, "error": str(broken)}
            if not members.skip():
                return


def read(spark: SparkSession, archives: DataFrame, payload: bool = True, strict: bool = True, id_type: str = "long") -> DataFrame:
    """All records of the archives named in column ``archive``, one task reading each from its start."""
    number = archives.count()
    parts = max(1, min(number, max(int(spark.conf.get("spark.sql.shuffle.partitions")), number // 8)))
    schema = RECORDS_SCHEMA.format("string")
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, inside = _place(archive)
                rows, held = [], 0
                with system.open_input_stream(inside, compression=None) as stream:
                    for row in records_of(stream, payload, strict):
                        rows.append({"archive": archive, **row})
                        held += len(row.get("payload") or b"")
                        if held >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    found = archives.select("archive").repartition(parts).mapInArrow(scanned, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _batch(rows: list[dict], names: list[str], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names]
    return pa.RecordBatch.from_arrays(arrays, names=names)
