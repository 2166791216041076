"""WARC archives: writer, and a sequential reader.

Each partition writes one archive, one gzip member per record, to the shared folder. An
archive gets its name only when it is complete and the manifest lists those of the tasks
that succeeded, so retried and speculative tasks leave no half archives behind. Of records
with equal payloads of at least ``min_bytes`` the one with the largest page_id is the
response, the others are revisits that name it.

The reader takes the manifest's archives one by one, inflates them in pieces (zlib), frames
records by Content-Length, and compares each payload's SHA-1 with its WARC-Payload-Digest.
Memory is one piece and, where payloads are asked for, one payload.

Files are reached through ``pyarrow.fs``, so the folder may be any store it knows
(file, hdfs, s3, gs, ...).

Defined results: a null payload is written as an empty one, a null url as a urn of the page;
repeated page_ids each get a record (equal rows: all responses, if theirs is the largest id);
a null page_id is kept (empty in its record's name) and is never named by a revisit; an empty
table gives no archive and no record; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches, scratch_path, staged

MIN_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 16
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One WARC/1.1 record, not compressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    uri = quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else record_id(page_id).strip("<>")
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Target-URI", uri), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if re.match(r"\w[\w+.-]+:", uri) else (fs.LocalFileSystem(), uri)


def references(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, payload_key, refers_to`` of the pages whose payload a larger page_id has."""
    ids = (pages.where(F.octet_length("html") >= min_bytes).where("page_id is not null")
           .select("page_id", F.unhex(F.sha2("html", 256)).alias("payload_key")))
    last = (ids.groupBy("payload_key").agg(F.max("page_id").alias("refers_to"),
                                           F.min("page_id").alias("least"))
            .where("least < refers_to").select("payload_key", "refers_to"))
    return ids.join(last, "payload_key").where("page_id < refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives under ``folder`` (made if missing)
    and returns their manifest: path, records, bytes."""
    bounded_batches(pages.sparkSession)
    plain = pages.select("page_id", "url", "html")
    refs = references(plain, min_bytes).select(
        "page_id", "payload_key", "refers_to")
    joined = plain.join(refs, "page_id", "left")

    def run(batches):
        store, top = _open(folder)
        store.create_dir(top, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        sink, n, size = None, 0, 0
        for batch in W.slices(batches, "html"):
            for page, url, html, key, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                if refers is not None and hashlib.sha256(payload).digest() != key:
                    refers = None  # another row of this page_id has the repeated payload
                data = member(record(page, url, payload, refers))
                sink = sink or store.open_output_stream(f"{top}/.{name}", compression=None)
                sink.write(data)
                n, size = n + 1, size + len(data)
        if sink:
            sink.close()
            store.move(f"{top}/.{name}", f"{top}/{name}")
            yield pa.record_batch([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([n], pa.int64()),
                                   pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return staged(joined.select("page_id", "url", "html", "payload_key", "refers_to")
                  .mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


@dataclass
class Record:
    headers: dict[str, str]
    payload_bytes: int = 0
    digest: str = ""
    payload: bytes | None = field(default=None, repr=False)


class _Member:
    """The inflated bytes of the next gzip member of a stream."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.raw = stream, rest
        self.z, self.out = zlib.decompressobj(31), b""

    def more(self) -> bytes:
        """The next inflated bytes, empty at the member's end."""
        while not self.z.eof:
            data = self.raw or self.stream.read(_PIECE)
            if not data:
                raise ValueError("the archive ends inside a gzip member")
            out = self.z.decompress(data, _PIECE)
            self.raw = self.z.unconsumed_tail or self.z.unused_data
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        while (at := self.out.find(mark)) < 0:
            got = self.more()
            if not got:
                raise ValueError("a record's header does not end")
            self.out += got
        head, self.out = self.out[:at], self.out[at + len(mark):]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly n bytes, in pieces."""
        while n:
            part = self.out or self.more()
            if not part:
                raise ValueError("a record is shorter than its Content-Length")
            self.out = part[n:]
            yield part[:n]
            n -= min(n, len(part))


def read_records(stream, with_payload: bool = False) -> Iterator[Record]:
    """The records of one archive, in order. Raises ValueError on a broken frame or digest."""
    rest = stream.read(_PIECE)
    while rest:
        m = _Member(stream, rest)
        lines = m.until(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        left = int(headers["content-length"])
        sha, kept, size, seen = hashlib.sha1(), [], 0, b""
        in_body = not headers.get("content-type", "").startswith("application/http")
        for part in m.take(left):
            if not in_body:
                seen += part
                at = seen.find(b"\r\n\r\n")
                if at < 0:
                    continue
                in_body, part = True, seen[at + 4:]
            sha.update(part)
            size += len(part)
            if with_payload:
                kept.append(part)
        if b"".join(m.take(4)) != b"\r\n\r\n" or m.out or m.more():
            raise ValueError("a record's end is not where its Content-Length puts it")
        digest = headers.get("warc-payload-digest", "")
        if headers.get("warc-type") != "revisit" and digest:
            if base64.b32decode(digest.removeprefix("sha1:")) != sha.digest():
                raise ValueError(f"payload digest of {headers.get('warc-record-id')} differs")
        yield Record(headers, size, digest, b"".join(kept) if with_payload else None)
        rest = m.raw or stream.read(_PIECE)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` (hex SHA-1)
    and the payload if asked for, one row per record; archives are dealt out by path. A
    revisit's own payload is empty here: ``resolved`` adds what it refers to."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = _open(path)
                with store.open_input_stream(name, compression=None) as stream:
                    yield from _rows(read_records(stream, with_payload), with_payload)

    n = manifest.agg(F.count("*")).first()[0]
    schema = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
              "payload_digest string" + ", payload binary" * with_payload)
    return manifest.select("path").repartition(max(1, n), "path").mapInArrow(run, schema)


def _rows(records: Iterator[Record], with_payload: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0

    def batch():
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                 ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), *[("payload", pa.binary())] * with_payload]
        cols = list(zip(*rows))
        return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], [k for k, _ in kinds])

    for r in records:
        h = r.headers
        url = h.get("warc-target-uri", "")
        row = (_page(h.get("warc-record-id")), None if url.startswith("urn:page:") else url,
               h.get("warc-type"), _page(h.get("warc-refers-to")), r.payload_bytes,
               base64.b32decode(r.digest.removeprefix("sha1:")).hex() if r.digest else None)
        rows.append((*row, r.payload) if with_payload else row)
        size += len(r.payload or b"")
        if len(rows) >= 1000 or size >= W.SLICE_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def resolved(records: DataFrame) -> DataFrame:
    """Records with the full payload's size also for revisits, from the response named."""
    own = records.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("to"), F.col("payload_digest").alias("same")).agg(
        F.max("payload_bytes").alias("full"))
    return (records.join(own, (F.col("refers_to") == F.col("to")) &
                         (F.col("payload_digest") == F.col("same")), "left")
            .withColumn("payload_bytes", F.when(F.col("record_type") == "revisit", F.col("full"))
                        .otherwise(F.col("payload_bytes"))).drop("to", "same", "full"))


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the pages as archives in the shared folder and reads them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    records = read_warc(write_warc(pages, folder, min_bytes))
    return resolved(staged(records, "warc-records"))
