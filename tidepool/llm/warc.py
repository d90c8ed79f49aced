"""WARC archives written and read as a chunked record table.

A record is never held whole by the Python side: pages are cut into rows of
(record, chunk number, bytes) on the JVM side, the writer streams those rows into
gzip members of an archive, and the reader streams an archive back into chunk
rows, each carrying the digest of its record up to there. The last chunk of a
record therefore has the digest and length of the whole payload.

Archives are standard WARC 1.1 with one gzip member per record. Tasks write them
through ``pyarrow.fs`` into a shared folder: under a name of the attempt first,
moved to the final name when complete, so a lost or repeated attempt leaves no
half archive and rewrites equal bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import staged, table
from tidepool.session import checkpoint_root

CHUNK_BYTES = 64 << 10
ARCHIVE_BYTES = 128 << 20
# Fixed value: profile of the WARC 1.1 standard for equal payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("archive string, record long, chunk_no long, data binary, digest string, payload_bytes long, "
                 "last boolean, page_id long, record_type string, refers_to long, target_uri string")
ARROW_RECORDS = pa.schema([
    ("archive", pa.string()), ("record", pa.int64()), ("chunk_no", pa.int64()), ("data", pa.binary()),
    ("digest", pa.string()), ("payload_bytes", pa.int64()), ("last", pa.bool_()), ("page_id", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])


def _open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _head(r: dict) -> bytes:
    """The header of a record and, for a response, of the HTTP message in it."""
    digest = _base32(bytes.fromhex(r["sha"]))
    uri = quote(r["url"], safe="%/:=&?~#+!$,;'@()*[]") if r["url"] else f"urn:page:{r['page_id']}"
    http = b""
    if r["record_type"] == "response":
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {r['size']}\r\n\r\n").encode()
    fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", _record_id(r["page_id"], digest)),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(r["size"]))]
    if r["page_id"] is not None:
        fields.append(("X-Page-Id", str(r["page_id"])))
    if r["record_type"] == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(r["refers_to"], digest)),
                   ("X-Refers-To-Page-Id", str(r["refers_to"]))]
        length = 0
    else:
        fields.append(("Content-Type", "application/http;msgtype=response"))
        length = len(http) + r["size"]
    fields.append(("Content-Length", str(length)))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


class _Archives:
    """Archives of one task, rolled over at about ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str):
        self.fs, self.root = _open_fs(folder)
        context = TaskContext.get()
        self.part, self.attempt = context.partitionId(), context.taskAttemptId()
        self.n, self.out = 0, None
        self.done: list[tuple[str, int]] = []

    def open(self) -> None:
        if self.out is None:
            # Named by the attempt: a retried or speculative one never meets another's file, and
            # the manifest names those that count.
            self.path = posixpath.join(self.root, f"{self.part:06d}-{self.n:04d}-{self.attempt}.warc.gz")
            self.out, self.records = self.fs.open_output_stream(self.path, compression=None), 0

    def begin(self, head: bytes) -> None:
        self.open()
        self.gz = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self.out.write(self.gz.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self.out.write(self.gz.flush())
        self.records += 1
        if self.out.tell() >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.records))
            self.out, self.n = None, self.n + 1


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """One WARC record per row of ``pages`` (page_id, url, html): ``archive, records``.

    Of the pages with equal payloads (same SHA-1 and length) of at least
    ``min_bytes``, rows with the smallest page_id become responses and the others
    revisits of it; smaller payloads are all responses. Null html is an empty
    payload. A null page_id is never the smallest; pages whose group has no
    page_id at all are responses. Repeated rows give repeated records. Extra
    columns are ignored; an empty table gives no archive.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).select(
        "*", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("size"))
    groups = staged(spark, rows.groupBy("sha", "size")
                    .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                    .filter(F.col("n") > 1).filter(F.col("size") >= min_bytes)
                    .filter("first_id is not null").drop("n"), "warc-groups")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    chunks = (rows.join(groups, ["sha", "size"], "left")
              .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
              .withColumn("refers_to", F.when(revisit, F.col("first_id")))
              .withColumn("n_chunks", F.when(revisit, 1).otherwise(
                  F.greatest(F.lit(1), F.ceil(F.col("size") / CHUNK_BYTES))).cast("int"))
              .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
              .select("page_id", "url", "sha", "size", "record_type", "refers_to", "n_chunks", "chunk_no",
                      F.when(F.col("record_type") == "response", F.substring(
                          F.col("payload"), F.col("chunk_no") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))).alias("data")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder)
        for batch in batches:
            data = batch.column("data")
            for i, r in enumerate(batch.drop_columns(["data"]).to_pylist()):
                if r["chunk_no"] == 0:
                    archives.begin(_head(r))
                if r["record_type"] == "response":
                    archives.add(data[i].as_buffer())
                if r["chunk_no"] == r["n_chunks"] - 1:
                    archives.end()
        archives.close()
        yield pa.RecordBatch.from_pydict({"archive": [a for a, _ in archives.done],
                                          "records": [n for _, n in archives.done]},
                                         pa.schema([("archive", pa.string()), ("records", pa.int64())]))

    store, root = _open_fs(folder)
    store.create_dir(root, recursive=True)
    return staged(spark, chunks.mapInArrow(write, "archive string, records long"), "warc-manifest")


def read_records(stream: BinaryIO, archive: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of one gzipped archive, in order, reading ``chunk_bytes`` at a time."""
    g = gzip.GzipFile(fileobj=stream)
    record = 0
    while line := g.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{archive}: no WARC record at {g.tell()}")
        h = {}
        while (line := g.readline()).strip():
            k, _, v = line.decode().partition(":")
            h[k.strip().lower()] = v.strip()
        left, kind = int(h["content-length"]), h["warc-type"]
        if h.get("content-type", "").startswith("application/http"):
            while left and (line := g.readline()):
                left -= len(line)
                if line == b"\r\n":
                    break
        sha, n, no = hashlib.sha1(), 0, 0
        declared = h["warc-payload-digest"].partition(":")[2]
        while True:
            data = g.read(min(left, chunk_bytes)) if left else b""
            if left and not data:
                raise EOFError(f"{archive}: record {record} is cut off")
            left -= len(data)
            n += len(data)
            sha.update(data)
            digest, last = _base32(sha.copy().digest()), left == 0
            if kind == "revisit":
                digest, n = declared, int(h["x-payload-length"])
            elif last and digest != declared:
                raise ValueError(f"{archive}: record {record} differs from its digest")
            yield {"archive": archive, "record": record, "chunk_no": no, "data": data, "digest": digest,
                   "payload_bytes": n, "last": last, "record_type": kind,
                   "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
                   "refers_to": int(h["x-refers-to-page-id"]) if kind == "revisit" else None,
                   "target_uri": h["warc-target-uri"]}
            no += 1
            if last:
                break
        record += 1


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The chunked record table of the archives named in ``manifest`` (archive).

    Columns: ``archive, record, chunk_no, data, digest, payload_bytes, last,
    page_id, record_type, refers_to, target_uri``; ``digest`` and ``payload_bytes``
    cover the record's payload up to this chunk (a revisit's: the full payload it
    stands for). A payload that differs from its stored digest is an error.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open_fs(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(archive, compression=None) as f:
                    for r in read_records(f, archive):
                        rows.append(r)
                        held += len(r["data"]) + 300
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, ARROW_RECORDS)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ARROW_RECORDS)

    n = max(1, manifest.count())
    return manifest.select("archive").repartition(n, "archive").mapInArrow(read, RECORD_SCHEMA)


def op9_warc(spark, sf_dir):
    """What the archives hold of every page."""
    folder = f"{checkpoint_root(spark)}/tidepool-warc/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder).filter("last").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
