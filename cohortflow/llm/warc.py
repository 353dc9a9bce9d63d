"""WARC archives: a writer of gzip members and a reader whose tasks own byte ranges.

Every record is a gzip member of its own. A reading task scans its range for gzip magic, validates a
candidate by decompressing the start of the member and looking for a WARC version line, and owns
the records that start inside the range; it reads past the end to finish the last one. Files are
opened through ``pyarrow.fs`` by their address, so the archive may be in any store that it knows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.llm.common import scratch_path, slices, stage

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
RANGE_BYTES = 4 << 20
READ_BYTES = 1 << 20
PIECE_BYTES = 1 << 14
LEVEL = 6
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "file string, offset bigint, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)


def digest_of(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int) -> str:
    """A page's record id."""
    return f"<urn:page:{page_id}>"


def page_of(uri: str | None) -> int | None:
    """The page of a record id."""
    return int(uri[len("<urn:page:") : -1]) if uri and uri.startswith("<urn:page:") else None


def record_bytes(page_id: int, url: str | None, payload: bytes, refers_to: int | None, level: int = LEVEL) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit without.

    Both hold HTTP headers; those of a revisit still tell the payload's length. A null address gives no target line.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_uri(page_id)}",
        f"WARC-Date: {EPOCH}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html and ``refers_to``: the smallest page_id with an equal payload of at least ``least`` bytes.

    Null where the page itself is that one or its payload is smaller; null html is empty. Equal payloads are met
    by digest in a join, so a payload that very many pages share is split like any skewed key. Rows
    without page_id are left out; rows that repeat a page_id are written each.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).where("page_id is not null")
    rows = rows.withColumn("_digest", F.sha2("html", 256))
    first = rows.select("_digest", "page_id").groupBy("_digest").agg(F.min("page_id").alias("_first"))
    repeated = (F.octet_length("html") >= least) & (F.col("_first") != F.col("page_id"))
    return rows.join(first, "_digest").select("page_id", "url", "html", F.when(repeated, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, level: int = LEVEL) -> DataFrame:
    """Write a record per row (page_id, url, html, refers_to), an archive per task; gives ``file``, ``bytes``.

    A task writes under a name of its attempt and renames it when it is complete, so a task that is run again
    leaves one archive. The listing is written beside the archives.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():05d}.warc.gz"
        attempt = f"{folder}/_{name}.{context.taskAttemptId()}"
        size = 0
        with store.open_output_stream(attempt, compression=None) as out:
            for batch in batches:
                for part in slices(batch, "html"):
                    columns = (part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))
                    for page_id, url, html, refers_to in zip(*columns):
                        size += out.write(record_bytes(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to, level))
        if size:
            store.move(attempt, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{name}"]), pa.array([size], pa.int64())], ["file", "bytes"])
        else:
            store.delete_file(attempt)

    return stage(pages.mapInArrow(written, "file string, bytes bigint"), "archives", f"{path}/listing")


class Range:
    """Bytes of a file from ``start`` on, read as far as they are asked for."""

    def __init__(self, stream, start: int, size: int):
        self.stream, self.size = stream, size
        self.base, self.data = start, b""
        stream.seek(start)

    def upto(self, end: int) -> None:
        """Have the bytes up to file position ``end``, or to the end of the file."""
        while self.base + len(self.data) < min(end, self.size):
            more = self.stream.read(READ_BYTES)
            if not more:
                break
            self.data += more

    def forget(self, position: int) -> None:
        """Drop what is before file position ``position``, once that is much."""
        if position - self.base >= READ_BYTES:
            self.data = self.data[position - self.base :]
            self.base = position

    def find_magic(self, position: int, end: int) -> int:
        """First gzip magic at or after ``position`` that starts before ``end``; -1 if there is none."""
        while position < end:
            self.upto(position + READ_BYTES)
            at = self.data.find(MAGIC, position - self.base)
            if at >= 0:
                return self.base + at if self.base + at < end else -1
            have = self.base + len(self.data)
            if have >= self.size:
                return -1
            position = max(position, have - len(MAGIC) + 1)
        return -1

    def member(self, position: int) -> tuple[bytes, int] | None:
        """The member at ``position`` and where it ends; None if no valid WARC record starts there."""
        unpacker, out, at, seen = zlib.decompressobj(31), [], position, 0
        while not unpacker.eof:
            self.upto(at + PIECE_BYTES)
            piece = self.data[at - self.base : at - self.base + PIECE_BYTES]
            if not piece:
                return None
            try:
                out.append(unpacker.decompress(piece))
            except zlib.error:
                return None
            at += len(piece)
            if seen < len(VERSION):
                start = b"".join(out)[: len(VERSION)]
                seen = len(start)
                if not VERSION.startswith(start) and not start.startswith(VERSION):
                    return None
        return b"".join(out), at - len(unpacker.unused_data)


def fields_of(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name."""
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if value}


def parse_record(raw: bytes) -> dict | None:
    """A record's fields and payload; None if its header or length is no good."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found or not head.startswith(VERSION):
        return None
    fields = fields_of(head)
    length = fields.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        return None
    block = rest[: int(length)]
    payload, told = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = fields_of(http).get("content-length")
    kind = fields.get("warc-type", "")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = kind == "revisit"
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest if revisit else digest_of(payload),
        "payload_bytes": int(told) if revisit and told and told.isdigit() else len(payload),
        "payload": None if revisit else payload,
    }


def read_range(path: str, start: int, end: int) -> Iterator[dict]:
    """Records of an archive that start at ``start`` or later and before ``end``."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as stream:
        window = Range(stream, start, stream.size())
        position = start
        while (at := window.find_magic(position, end)) >= 0:
            window.forget(at)
            member = window.member(at)
            record = parse_record(member[0]) if member else None
            if record is None:
                position = at + 1
                continue
            yield {"file": path, "offset": at} | record
            position = member[1]


#: Tasks that ranges are dealt to at most; with more ranges a task reads several.
MOST_TASKS = 100_000


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (file, bytes), in tasks of ``range_bytes`` each.

    ``payloads`` off leaves them out of the result; digests and lengths still come from the whole payload.
    """
    ends = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint")))
    n = files.agg(F.sum(F.greatest(F.ceil(F.col("bytes") / range_bytes), F.lit(1)))).first()[0] or 1
    # A number given is kept: rows of some bytes would else be merged into one task, however much each has to read.
    ranges = files.select("file", "bytes", ends.alias("start")).repartition(min(int(n), MOST_TASKS), "file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("file", pa.string()),
                ("offset", pa.int64()),
                ("record_type", pa.string()),
                ("record_id", pa.string()),
                ("target_uri", pa.string()),
                ("refers_to", pa.string()),
                ("payload_digest", pa.string()),
                ("payload_bytes", pa.int64()),
                ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for path, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows, held = [], 0
                for record in read_range(path, start, start + range_bytes):
                    held += len(record["payload"] or b"")
                    rows.append(record if payloads else record | {"payload": None})
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(read, RECORD)


def archive_roundtrip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages written to archives in the shared folder and read back, without their payloads."""
    path = scratch_path(spark, "warc")
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    files = write_archives(with_revisits(pages, least), uri)
    page = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).cast("bigint")
    rows = read_archives(files, payloads=False)
    return rows.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("refers_to").isNotNull(), page("refers_to")).alias("refers_to"),
    )
