"""Writing and reading WARC 1.1 archives as chunked records.

An archive is written from a table of chunk rows: a payload up to chunk_bytes is one
record; a longer one is a first segment and continuation records, each a row keyed by
record id and segment number. A payload comes as a value of the pages table, so it is in
memory as part of an Arrow batch; beyond that, chunks are views into that buffer, digests
are carried from chunk to chunk, and chunk rows go on as they are made, a few megabytes
at a time. No record is longer than a chunk, and reading holds one line at a time.

Every record is a gzip member of its own, as readers of archives expect. Spark's text
writer makes the files through its commit protocol, so lost executors leave no half
archive behind, and any file system that Spark knows will do: a row is a member without
its last byte, which is zero (the high byte of the length of a record below 16 MB), and
zero is the line separator. The files are then renamed to .warc.gz. This hangs on Spark's
text writer passing the bytes of strings on as they are, without asking whether they are
UTF-8, as it does; a test reads every member back with another reader.

Payloads are UTF-8 texts of any length; null is the empty payload. Records of equal
payload (of min_bytes at least) are one response, the one with the smallest page_id, and
revisits to it; repeated rows with that page_id are responses too. Rows without page_id
revisit like others, and are responses where no equal payload has an id. Record ids are
unique: rows that share a page_id, or lack it, are numbered. An empty table makes an
archive without records. Columns of the pages but page_id, url and the payload play no
part, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, bytes_of, has_rows, join_hot, new_path, store, trim
from .ranks import rank_within

#: Payload bytes in a record at most; longer payloads are segmented.
CHUNK = 1 << 20
#: Bytes of made records that a task holds before it hands them on.
HELD = 4 << 20
#: Groups of equal payloads, and repeated page_ids, that are broadcast at most (some 50 bytes each).
GROUPS = 400_000
_CRLF = b"\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_TYPES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, segments int"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunks(data: memoryview, most: int) -> Iterator[memoryview]:
    """Views of at most `most` bytes that don't cut a UTF-8 character; one empty view for no data."""
    begin, n = 0, len(data)
    while True:
        end = min(begin + max(most, 4), n)
        while end < n and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[begin:end]
        begin = end
        if begin >= n:
            return


def _id(page: str, nth: int = 0) -> bytes:
    return b"urn:page:" + page.encode() + (b":copy:%d" % nth if nth else b"")


def plan_revisits(pages: DataFrame, payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """pages with _first (page_id of the response of an equal payload; null where alone).

    Payloads stay where they are while their groups are few; only digests move.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    keyed = pages.withColumn("_hash", F.when(F.octet_length(body) >= min_bytes, F.unhex(F.sha2(body.cast("binary"), 256))))
    groups = keyed.where("_hash is not null").groupBy("_hash").agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies"))
    groups = store(groups.where("_copies > 1"), "groups")
    if bounded(groups, GROUPS):
        out = keyed.join(F.broadcast(groups), "_hash", "left")
    else:
        out = join_hot(keyed, groups, "_hash", "_copies", "left")
    return out.drop("_hash", "_copies")


def number_copies(pages: DataFrame, payload: str = "html") -> DataFrame:
    """pages with _id (page_id as text) and _nth, which tells apart the rows of one page_id or without one."""
    pages = pages.withColumn("_id", F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    repeated = store(pages.groupBy("_id").agg(F.count("*").alias("_rows")).where("_rows > 1 or _id = 'none'").select("_id"), "repeated")
    if not has_rows(repeated):
        return pages.withColumn("_nth", F.lit(0).cast("long"))
    few = F.broadcast(repeated) if bounded(repeated, GROUPS) else repeated
    again = store(pages.join(few, "_id", "left_semi").withColumn("_row", F.monotonically_increasing_id()), "copies")
    ranked = rank_within(again, "_id", [F.col("_row")], F.col("_row"), max(8, again.count() // 20_000), "_nth").drop("_row")
    return pages.join(few, "_id", "left_anti").withColumn("_nth", F.lit(0).cast("long")).unionByName(ranked)


def _source(pages: DataFrame, payload: str) -> DataFrame:
    return pages.select("page_id", "url", "_first", "_id", "_nth", F.coalesce(F.col(payload), F.lit("")).alias("_body"))


def records(pages: DataFrame, payload: str = "html", chunk_bytes: int = CHUNK) -> DataFrame:
    """The archive as rows (record_id, segment, value); value is a record with its closing line breaks."""
    return _source(pages, payload).mapInArrow(_recorder(chunk_bytes), "record_id string, segment int, value binary")


def _recorder(chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes batches of chunk rows of batches of pages."""

    def head(kind: bytes, rid: bytes, *fields: bytes) -> bytes:
        return _CRLF.join([b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + rid + b">", b"WARC-Date: 1970-01-01T00:00:00Z", *fields])

    def made(page: int | None, url: str | None, first: int | None, rid: bytes, data: memoryview) -> Iterator[bytes]:
        sha = hashlib.sha1()
        for part in chunks(data, chunk_bytes):
            sha.update(part)
        shared = [b"WARC-Payload-Digest: sha1:" + _base32(sha.digest()).encode(), b"X-Payload-Length: %d" % len(data)]
        if url is not None:
            shared.append(b"WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url).encode())
        if first is not None and first != page:
            yield head(b"revisit", rid, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <" + _id(str(first)) + b">", *shared, b"Content-Length: 0") + _CRLF * 4
            return
        cut = len(data) > chunk_bytes
        for n, part in enumerate(chunks(data, chunk_bytes), 1):
            block = _HTTP if n == 1 else b""
            size = b"Content-Length: %d" % (len(block) + len(part))
            if n == 1:
                top = head(b"response", rid, *shared, *([b"WARC-Segment-Number: 1"] if cut else []), b"Content-Type: application/http; msgtype=response", size)
            else:
                top = head(b"continuation", rid + b":segment:%d" % n, b"WARC-Segment-Origin-ID: <" + rid + b">", b"WARC-Segment-Number: %d" % n, size)
            yield b"".join([top, _CRLF * 2, block, part, _CRLF * 2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, segments, values, held = [], [], [], 0
        for batch in batches:
            raw, starts, ends = bytes_of(batch.column(5))
            view = memoryview(raw)
            for i, (page, url, first, name, nth) in enumerate(zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True)):
                rid = _id(name, nth)
                for n, value in enumerate(made(page, url, first, rid, view[starts[i] : ends[i]]), 1):
                    ids.append(rid.decode())
                    segments.append(n)
                    values.append(value)
                    held += len(value)
                    if held > HELD:
                        yield _rows(ids, segments, values)
                        ids, segments, values, held = [], [], [], 0
        yield _rows(ids, segments, values)
        trim()

    def _rows(ids: list, segments: list, values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(segments, pa.int32()), pa.array(values, pa.binary())], names=["record_id", "segment", "value"])

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record's gzip member without its last byte, as text that Spark writes as it is."""
    for batch in batches:
        members = [gzip.compress(v, 6, mtime=0) for v in batch.column(2).to_pylist()]
        if any(m[-1] for m in members):
            raise ValueError("a record must be shorter than 16 MB")
        offsets = np.append(0, np.cumsum([len(m) - 1 for m in members])).astype(np.int32)
        data = b"".join([m[:-1] for m in members])
        yield pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(len(members), pa.py_buffer(offsets), pa.py_buffer(data))], names=["value"])


def write(pages: DataFrame, path: str, payload: str = "html", chunk_bytes: int = CHUNK, min_bytes: int = 0) -> None:
    """Writes pages (page_id, url, payload) as WARC files, a gzip member a record, under path."""
    spark = pages.sparkSession
    planned = number_copies(plan_revisits(pages.select("page_id", "url", payload), payload, min_bytes), payload)
    make = _recorder(chunk_bytes)
    _source(planned, payload).mapInArrow(lambda batches: _members(make(batches)), "value string").write.option("lineSep", "\0").text(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store_ = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in store_.listStatus(folder):  # names of files only
        old = status.getPath()
        if old.getName().endswith(".txt"):
            store_.rename(old, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, old.getName()[:-4] + ".warc.gz"))


class _Reader:
    """Follows an archive line by line (lines end in CRLF); holds one line at a time."""

    def __init__(self, payloads: bool):
        self.payloads, self.fields, self.left, self.http, self.page, self.out = payloads, {}, 0, False, None, []

    def line(self, line: memoryview) -> None:
        if self.left > 0:
            self.left -= len(line)
            if not self.http:
                self.body(line)
            if self.left:  # the line's CRLF is the block's; else it closes the record
                self.left -= 2
                if not self.http:
                    self.body(_CRLF)
                elif not len(line):
                    self.http = False
        elif len(line):
            name, _, value = bytes(line).partition(b":")
            self.fields[name.lower()] = value.strip()
        elif self.fields:
            self.begin()

    def begin(self) -> None:
        fields, self.fields = self.fields, {}
        kind, page = fields[b"warc-type"], lambda k: None if (v := fields[k].strip(b"<>").split(b":")[2]) == b"none" else int(v)
        self.left, self.http = int(fields[b"content-length"]), False
        if kind != b"continuation":
            self.flush()
            self.page = {"page_id": page(b"warc-record-id"), "record_type": kind.decode(), "refers_to": page(b"warc-refers-to") if kind == b"revisit" else None, "declared": fields[b"warc-payload-digest"].decode().partition(":")[2], "payload_bytes": int(fields[b"x-payload-length"]) if kind == b"revisit" else 0, "segments": 0, "sha": hashlib.sha1(), "payload": []}
            self.http = kind == b"response"
        self.page["segments"] += 1

    def body(self, data) -> None:
        self.page["sha"].update(data)
        self.page["payload_bytes"] += len(data)
        if self.payloads:
            self.page["payload"].append(bytes(data))

    def flush(self) -> None:
        if self.page:
            page, sha = self.page, self.page.pop("sha")
            page["payload_digest"] = page["declared"] if page["record_type"] == "revisit" else _base32(sha.digest())
            if page["payload_digest"] != page.pop("declared"):
                raise ValueError(f"payload of page {page['page_id']} doesn't match its digest")
            page["payload"] = b"".join(page["payload"]).decode() if self.payloads and page["record_type"] != "revisit" else None
            self.out.append(page)
        self.page = None


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records under path, one row per page; with payloads, those of responses too.

    A gzip file is read by one task from its start, so lines come in order; a line holds
    one chunk at most. Digests of responses are computed anew and compared. With payloads
    a whole payload is put together as a value of a row; without, nothing longer than a line.
    """
    names = [c.split(" ")[0] for c in _TYPES.split(", ")] + (["payload"] if payloads else [])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(payloads)

        def rows() -> pa.RecordBatch:
            out, reader.out = reader.out, []
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds, strict=False)], names=names)

        for batch in batches:
            raw, starts, ends = bytes_of(batch.column(0))
            view = memoryview(raw)
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                reader.line(view[a:b])
            yield rows()
        reader.flush()
        yield rows()
        trim()

    lines = spark.read.option("lineSep", "\r\n").text(path)
    return lines.select("value").mapInArrow(run, _TYPES + (", payload string" if payloads else ""))


def round_trip(pages: DataFrame, payload: str = "html", chunk_bytes: int = CHUNK, min_bytes: int = 0) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back."""
    path = new_path(pages.sparkSession, "warc")
    write(pages, path, payload, chunk_bytes, min_bytes)
    return read(pages.sparkSession, path)
