"""WARC writing and reading (operator 9).

Archives are files of one gzip member per record in the folder that all
executors share. The writer fills them in bounded pieces; the reader takes an
archive sequentially: it inflates incrementally, splits members where one
ends, frames each record by its Content-Length and verifies its digests, and
holds one block of the file and one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import in_small_batches, new_path, written

#: Equal payloads from this many bytes on are written once and revisited.
LEAST_REVISIT = 1000
BLOCK = 1 << 18
ARCHIVE_BYTES = 64 << 20
LEVEL = 6


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, headers: list[tuple[str, str]], payload: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member. payload is the block after the HTTP head;
    a revisit carries the head alone and the full payload's digest."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head if kind == "revisit" else head + payload
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        *headers,
        ("WARC-Payload-Digest", sha1_label(payload)),
        ("WARC-Block-Digest", sha1_label(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(text.encode() + block + b"\r\n\r\n") + z.flush()


class _Members:
    """Bytes of consecutive gzip members, inflated as they are asked for."""

    def __init__(self, source, block: int = BLOCK):
        self.source, self.block = source, block
        self.raw, self.out = b"", bytearray()
        self.z = None

    def fill(self) -> bool:
        """More bytes of the current member; False at its end."""
        if self.z is None:
            self.raw = self.raw or self.source.read(self.block)
            if not self.raw:
                return False
            self.z = zlib.decompressobj(31)
        while not self.z.eof:
            if not self.raw:
                self.raw = self.source.read(self.block)
                if not self.raw:
                    raise ValueError("the archive ends within a member")
            got = self.z.decompress(self.raw, self.block)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.out += got
                return True
        return False

    def line(self) -> bytes:
        while (at := self.out.find(b"\r\n")) < 0:
            if not self.fill():
                raise ValueError("the member ends within a header")
        got = bytes(self.out[:at])
        del self.out[: at + 2]
        return got

    def take(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self.fill():
                raise ValueError("the member is shorter than its Content-Length")
        got = bytes(self.out[:n])
        del self.out[:n]
        return got

    def end(self) -> None:
        """To the end of the member, where nothing but the record's end is left."""
        while self.fill():
            pass
        if bytes(self.out) != b"\r\n\r\n":
            raise ValueError("the record is longer than its Content-Length")
        self.out.clear()
        self.z = None


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an open archive.
    Raises ValueError where framing or a digest is wrong."""
    m = _Members(source)
    while m.out or m.fill():
        if m.line() != b"WARC/1.1":
            raise ValueError("no WARC record here")
        headers = {}
        while line := m.line():
            k, _, v = line.decode().partition(":")
            headers[k.strip().lower()] = v.strip()
        block = m.take(int(headers["content-length"]))
        m.end()
        if sha1_label(block) != headers["warc-block-digest"]:
            raise ValueError("the block digest is wrong")
        payload = block.partition(b"\r\n\r\n")[2]
        if headers["warc-type"] == "response" and sha1_label(payload) != headers["warc-payload-digest"]:
            raise ValueError("the payload digest is wrong")
        yield headers, block


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if not path.startswith("file:") else path)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, level: int = LEVEL) -> DataFrame:
    """Write every row as a record into archives under `folder`; returns the
    archives' paths (path, n_records), already written.

    Which of equal payloads stands is found from digests alone (the largest
    page_id; null is the smallest), then each page meets its decision by a join
    on page_id and digest. Null html: an empty payload. Null url: an empty target. Rows that
    share a page_id are all written; if they share a payload too, one of them is
    a record like the other. A retried task writes new files; only those of the
    attempt that Spark counts are listed.
    """
    key = F.coalesce(F.col(page_id).cast("long"), F.lit(-(1 << 63)))
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = in_small_batches(pages).select(key.alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    digests = rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes")).where(F.col("bytes") >= least)
    digests = written(digests, "warc-digests")
    first = digests.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    first = written(first, "warc-first")  # a join of two plain shuffles, so that Spark can split a hot digest
    moved = digests.join(first, ["digest", "bytes"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    moved = written(moved, "warc-moved")  # here too, for a hot page_id
    rows = rows.withColumn("digest", F.sha1("payload"))
    same = rows.join(moved, ["page_id", "digest"], "left") if not moved.isEmpty() else rows.withColumn("refers_to", F.lit(None).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, path, size, n = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for b in batches:
            for pid, link, payload, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                revisit = refers is not None
                headers = [("WARC-Target-URI", (link or "").replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Date", "1970-01-01T00:00:00Z"), ("X-Page-ID", str(pid))]
                if revisit:
                    headers += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Payload-Bytes", str(len(payload)))]
                data = record("revisit" if revisit else "response", f"urn:page:{pid}", headers, payload, level)
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, size, n = f"{folder}/{name}", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())], names=["path", "n_records"])

    return written(same.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, n_records long"), "warc-files")


def read_archives(archives: DataFrame) -> DataFrame:
    """Read every archive named in column path: one row per record, page_id,
    payload_bytes, payload_digest (hex), record_type, refers_to, verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = _open(path)
                rows: list[tuple] = []
                with fs.open_input_stream(at, compression=None) as source:
                    for h, block in read_records(source):
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if h["warc-type"] == "revisit":
                            size, refers = int(h["x-payload-bytes"]), int(h["warc-refers-to"].strip("<>").rpartition(":")[2])
                        else:
                            size, refers = len(block) - block.index(b"\r\n\r\n") - 4, None
                        rows.append((int(h["x-page-id"]), size, digest, h["warc-type"], refers))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    # one archive a task: as many ranges of paths as there are paths
    each = archives.select("path").repartitionByRange(max(1, archives.count()), "path")
    out = each.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return out.withColumn("page_id", F.nullif("page_id", F.lit(-(1 << 63))))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, level: int = LEVEL) -> DataFrame:
    """Write all pages and read the archives back: one row per row of pages, those
    that repeat a page_id included, whether with one payload or with several.
    Nulls are as in write_archives(); an empty table gives no rows; other columns
    are ignored whatever their names."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, page_id, url, html, least, level))
