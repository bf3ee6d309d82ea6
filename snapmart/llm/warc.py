"""WARC archives of pages, written and read as a chunked record table.

A payload never stands whole in Python: Spark cuts it into rows (record,
chunk number, bytes), the writer streams them into one gzip member per record
and the reader yields them again, each row with the record's byte count and
SHA-1 so far; the last row of a record holds both for the whole payload and is
checked against the record's header.

Of records with equal payloads of at least ``revisit_from`` bytes, the one with
the largest page id is a ``response`` and the others are ``revisit`` records
that refer to it and repeat its digest and size, not its bytes.

Archives go to the shared folder through the file system of its URI. Each
attempt of a task writes files of its own; the stored manifest names those of
the attempts that Spark accepted, and only these are read.

Cases: null html is the empty payload; a null url is left out of the header; a
null page id never is referred to and its record is a response if no other page
has its payload; repeated rows with the largest id are responses all; an empty
table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stored
from snapmart.session import scratch_path

CHUNK = 1 << 18
ARCHIVE = 1 << 30  # an archive is closed once it has grown beyond
LEVEL = 4
LINE = b"\r\n"


def records(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """Pages with what their record's header says: page_id, url, payload
    (binary), payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    page = (pages.select("page_id", "url", payload.alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("same", F.sha2("payload", 256)))
    # copies meet as one row for each payload and task; the join's hot payloads can be split
    shared = stored(page.filter(F.col("payload_bytes") >= revisit_from).groupBy("same")
                    .agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).filter("n > 1").select("same", "newest"),
                    "warc-shared")
    again = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return page.join(shared, "same", "left").select(
        "page_id", "url", "payload", "payload_bytes", F.sha1("payload").alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("newest")).alias("refers_to"))


def chunked(recs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Records as rows of at most ``chunk`` payload bytes, in order; a revisit has one row without bytes."""
    last = F.when(F.col("record_type") == "revisit", 0).otherwise(
        F.greatest(F.ceil(F.col("payload_bytes") / chunk) - 1, F.lit(0))).cast("int")
    cut = recs.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    part = F.when(F.col("record_type") == "response", F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return cut.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "chunk_no", part.alias("bytes"))


def _header(r: dict, date: str) -> bytes:
    said = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n"
            if r["record_type"] == "response" else "")
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <urn:page:{said(r['page_id'])}>", f"WARC-Date: {date}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + r['payload_bytes'] if http else 0}",
             f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"Payload-Length: {r['payload_bytes']}"]
    if r["page_id"] is not None:
        lines.append(f"Page-ID: {r['page_id']}")
    if r["url"] is not None:
        lines.append(f"WARC-Target-URI: {said(r['url'])}")
    if r["refers_to"] is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{r['refers_to']}>")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    task = TaskContext.get()
    done: list[tuple[str, int]] = []
    out = pack = None
    n = 0

    def close_record() -> None:
        nonlocal pack
        if pack:
            out.write(pack.compress(LINE + LINE) + pack.flush())
            pack = None

    def close_archive() -> None:
        nonlocal out, n
        if out:
            close_record()
            done.append((out_name, n))
            out.close()
            out, n = None, 0

    for b in batches:
        for r in (dict(zip(b.schema.names, v, strict=True)) for v in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            if r["chunk_no"] == 0:
                close_record()
                if out and out.tell() > ARCHIVE:
                    close_archive()
                if out is None:
                    out_name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done)}.warc.gz"
                    out = store.open_output_stream(f"{root}/{out_name}", compression=None)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(pack.compress(_header(r, date)))
                n += 1
            if r["bytes"]:
                out.write(pack.compress(r["bytes"]))
    close_archive()
    yield pa.RecordBatch.from_pydict({"archive": pa.array([d[0] for d in done], pa.string()), "records": pa.array([d[1] for d in done], pa.int64())})


def write(recs: DataFrame, folder: str, chunk: int = CHUNK, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write archives under ``folder``; the stored manifest: archive, records."""
    return stored(chunked(recs, chunk).mapInArrow(partial(_write, folder=folder, date=date), "archive string, records long"), "warc-manifest")


class _Stream:
    """Decompressed bytes of an archive, read forward a little at a time."""

    def __init__(self, raw, block: int):
        self.raw, self.block, self.held, self.unpack = raw, block, b"", zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.unpack.eof:
                rest = self.unpack.unused_data
                self.unpack = zlib.decompressobj(31)
            else:
                rest = self.unpack.unconsumed_tail
            rest = rest or self.raw.read(self.block)
            if not rest:
                return False
            if got := self.unpack.decompress(rest, self.block):
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        got, self.held = self.held[:found], self.held[found + len(mark):]
        return got

    def take(self, most: int) -> bytes:
        while len(self.held) < most and self.more():
            pass
        got, self.held = self.held[:most], self.held[most:]
        return got


TABLE = ("record_id string, page_id long, record_type string, refers_to long, chunk_no int, last boolean, "
         "bytes binary, bytes_so_far long, sha1_so_far string")


def _read(batches: Iterator[pa.RecordBatch], folder: str, chunk: int, with_bytes: bool) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in TABLE.split(", ")]
    rows: list[tuple] = []
    size = 0

    def full() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for b in batches:
        for archive in b.column(0).to_pylist():
            with store.open_input_stream(f"{root}/{archive}", compression=None) as raw:
                s = _Stream(raw, 1 << 16)
                while (head := s.until(LINE + LINE)) is not None:
                    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                    page, length = h.get("Page-ID"), int(h["Payload-Length"])
                    refers = h.get("WARC-Refers-To")
                    key = (h["WARC-Record-ID"], page and int(page), h["WARC-Type"], refers and int(refers[10:-1]))
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "revisit":
                        rows.append((*key, 0, True, None, length, digest))
                    else:
                        s.until(LINE + LINE)  # the HTTP header
                        seen, sha, k = 0, hashlib.sha1(), 0
                        while True:
                            got = s.take(min(chunk, length - seen))
                            seen += len(got)
                            sha.update(got)
                            last = seen == length
                            if not (got or last) or last and sha.hexdigest() != digest:
                                raise ValueError(f"{archive}: payload of {key[0]} is damaged")
                            rows.append((*key, k, last, got if with_bytes else None, seen, sha.hexdigest()))
                            size, k = size + len(got) * with_bytes, k + 1
                            if size > 1 << 24 or len(rows) > 20_000:
                                yield full()
                                rows, size = [], 0
                            if last:
                                break
                    s.take(4)  # what ends a record
    if rows:
        yield full()


MOST_READERS = 20_000


def read(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_bytes: bool = True) -> DataFrame:
    """The chunked record table of the listed archives. The list is a few bytes
    an archive, so Spark would read all of them in one task: the number of
    tasks is given, one for each archive, MOST_READERS at most."""
    readers = min(max(manifest.count(), 1), MOST_READERS)
    return manifest.select("archive").repartition(readers, "archive").mapInArrow(
        partial(_read, folder=folder, chunk=chunk, with_bytes=with_bytes), TABLE)


def roundtrip(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """Write every page, read the archives back; one row per record."""
    folder = scratch_path(pages.sparkSession, "warc")
    back = read(write(records(pages, revisit_from), folder), folder, with_bytes=False)
    return back.filter("last").select("page_id", F.col("bytes_so_far").alias("payload_bytes"),
                                      F.col("sha1_so_far").alias("payload_digest"), "record_type", "refers_to")
