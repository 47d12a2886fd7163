"""WARC archives: a writer with one gzip member for each record, and a splittable reader.

Writer: every task writes one ``.warc.gz`` file into a shared folder, under an
attempt's own name first and then moved, so a repeated task replaces its file.
Of pages with equal payloads of at least ``min_bytes`` the largest page id
holds the payload (``response``); the others are ``revisit`` records that refer
to it and carry only the HTTP header.

Reader: archives are cut into byte ranges; a task looks for gzip's magic in its
range, decodes the start of each candidate member and takes it only if a WARC
version line follows, then reads member after member.  A record belongs to the
range that its first byte lies in and is read on beyond the range's end.

Defined cases: null html is the empty payload; a null page id is smaller than
any other (and stays null); rows that share the largest page id and the payload
are all responses; an empty table writes no record; a null url is left out;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import deploy, scratch, store

MAGIC = b"\x1f\x8b\x08"
WINDOW = 1 << 16
SPLIT_BYTES = 4 << 20
END = b"\r\n\r\n"


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, which states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, base = _filesystem(folder)
    task = TaskContext.get()
    name = f"{base}/part-{task.partitionId():05d}.warc.gz"
    own = f"{base}/.attempt-{task.taskAttemptId()}"
    files.create_dir(base, recursive=True)
    size = records = 0
    with files.open_output_stream(own) as out:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                for r in batch.slice(i, 64).to_pylist():
                    payload = (r["html"] or "").encode()
                    data = member(record(r["page_id"], r["url"], payload, digest_of(payload), r["refers_to"], r["refers_to"] is not None))
                    out.write(data)
                    size += len(data)
                    records += 1
    files.move(own, name)
    yield pa.RecordBatch.from_pylist([{"path": name, "bytes": size, "records": records}], schema=pa.schema(
        [("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the files: path, bytes, records."""
    deploy(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.sha1(html.cast("binary")).alias("sha"))
    holders = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.max("page_id").alias("holder"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("holder").isNotNull()).select(
        F.col("sha").alias("held"), "holder")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("holder")), F.lit(None)).otherwise(F.col("holder"))
    joined = rows.join(holders, F.col("sha") == F.col("held"), "left").select("page_id", "url", "html", refers.cast("long").alias("refers_to"))
    return store(joined.mapInArrow(lambda it: _write(it, folder), "path string, bytes long, records long"), "warc-files")


class _Members:
    """Gzip members of a file from a position on, one at a time."""

    def __init__(self, source, start: int, size: int):
        self.source, self.size, self.at, self.ahead = source, size, start, b""      # ``ahead``: bytes read from ``at`` on

    def fill(self, n: int) -> None:
        if len(self.ahead) < n and self.at + len(self.ahead) < self.size:
            self.source.seek(self.at + len(self.ahead))
            self.ahead += self.source.read(max(WINDOW, n - len(self.ahead)))

    def skip(self, n: int) -> None:
        self.at, self.ahead = self.at + n, self.ahead[n:]

    def valid(self) -> bool:
        """A member starts here whose first decoded bytes are a WARC version line."""
        self.fill(1024)
        if not self.ahead.startswith(MAGIC):
            return False
        try:
            return zlib.decompressobj(31).decompress(self.ahead[:1024], 7).startswith(b"WARC/1.")
        except zlib.error:
            return False

    def find(self, end: int) -> bool:
        """Move to the first valid member that starts before ``end``."""
        while self.at < min(end, self.size):
            self.fill(WINDOW)
            k = self.ahead.find(MAGIC)
            if k < 0:
                self.skip(max(len(self.ahead) - len(MAGIC) + 1, 1))
                continue
            self.skip(k)
            if self.at >= end:
                return False
            if self.valid():
                return True
            self.skip(1)
        return False

    def read(self) -> bytes:
        """The whole member that starts here; moves behind it."""
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not self.ahead:
                self.fill(WINDOW)
                if not self.ahead:
                    raise EOFError(f"gzip member cut off at byte {self.at}")
            out.append(z.decompress(self.ahead))
            self.skip(len(self.ahead) - len(z.unused_data))
        return b"".join(out)


def parse(data: bytes) -> dict:
    """Header fields and payload of one record; a response's payload must match its digest."""
    head, _, rest = data.partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(END)
    http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    page = lambda v: int(v[10:-1]) if v and v[10:-1] else None  # noqa: E731   <urn:page:N>
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest_of(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "payload_bytes": int(http_fields["Content-Length"]), "payload_digest": digest, "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": payload if fields["WARC-Type"] == "response" else None}


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_range(source, size: int, start: int, end: int) -> Iterator[dict]:
    """Records whose first byte lies in ``start`` .. ``end - 1``."""
    m = _Members(source, start, size)
    while m.find(end):
        while m.at < end and m.valid():
            yield parse(m.read())


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            files, path = _filesystem(r["path"])
            rows, held = [], 0
            with files.open_input_file(path) as source:
                for x in read_range(source, r["bytes"], r["start"], r["end"]):
                    if not payloads:
                        x["payload"] = None
                    rows.append(x)
                    held += len(x["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """Records of the archives listed in ``files`` (path, bytes), read in byte ranges of ``split_bytes``."""
    deploy(files.sparkSession)
    step = F.lit(split_bytes).cast("long")
    ranges = files.filter(F.col("bytes") > 0).select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("start")).withColumn(
        "end", F.least(F.col("start") + step, F.col("bytes")))
    n = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(1))).first()[0]
    dealt = ranges.repartitionByRange(max(1, int(n)), "path", "start")
    kind = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return dealt.mapInArrow(lambda it: _read(it, payloads), kind)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write the pages into a new shared folder and read the archives' records back, without payloads."""
    spark: SparkSession = pages.sparkSession
    files = write_archives(pages, scratch(spark, "warc"), min_bytes)
    return read_archives(files, split_bytes, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
