"""Lines that many documents share stay in one of them: what goes is told by bitmaps.

A line's key is the line without white space at its ends and with A-Z in lower case. A
key of `least` code points or more that stands in `documents` documents or more loses all
its lines but those of the document with the largest doc_id that holds it.

Each document gives one row for each of its keys: 128 bits of the key, doc_id, the row's
own 128 bits, and the lines' numbers. The rows are dealt by ranges of (key, doc_id from
the largest down, row) and sorted so within a range; a task then reads its rows as a
stream. The first document of a key keeps its lines, and once a third has been seen, what
came after the first goes. A key that a third of all rows share is dealt over many
ranges; only a task's first and last key can stand in several, so their rows are told
apart by a table of two rows a task. A task holds the rows of one document of one key, up
to HELD of them.

What comes back is a bitmap for each document that loses lines, as many bits as there are
lines up to its last one that goes, 1 where a line stays, deflated. Texts are read where
they are: the bitmaps are sent to them while they are few, else both go by row.

Defined results: null or empty text is one empty line. A document is a doc_id: rows that
share one count once and are kept or cut together, rows without one count as one document,
smaller than all others. Equal rows are cut alike. Lines of one key in the document that
keeps them all stay. Other columns play no part or stay as they are; an empty table gives
no rows. Texts and lines of any length are read whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels
from .common import bounded, row_key, settled, slices, store, unused

#: Code points of a key, and documents that hold it, from which its lines go.
LEAST, DOCUMENTS = 20, 3
#: Rows of one document and key that a task holds before it hands them on undecided.
HELD = 10_000
#: Rows that a task remembers, so that equal ones are read once.
REMEMBERED = 100_000
#: Bitmaps that are broadcast at most, and their bytes.
BITMAPS, BITMAP_BYTES = 200_000, 16 << 20

_SPACE = b" \t\n\x0b\x0c\r"
_ENTRY = "h1 long, h2 long, doc_id long, k1 long, k2 long, lines array<int>"
_NAMES = ["h1", "h2", "doc_id", "k1", "k2", "lines"]
_TYPES = [pa.int64()] * 5 + [pa.list_(pa.int32())]
GOES, OPEN, TOTAL = 0, 1, 2


def lines_of(raw: bytes, least: int = LEAST) -> dict[bytes, list[int]]:
    """The numbers of the lines of each key of `least` code points or more."""
    own: dict[bytes, list[int]] = {}
    for i, line in enumerate(raw.split(b"\n")):
        if len(line) >= least:
            key = line.strip(_SPACE).lower()  # of bytes: A-Z alone
            if len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least):
                own.setdefault(key, []).append(i)
    return own


def entries(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(h1, h2, doc_id, k1, k2, lines) for each key of each row of docs (doc_id, text, k1, k2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(1))
            view, digests, row, lines = memoryview(data), [], [], []
            for i, mark in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if mark in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(mark)
                for key, at in lines_of(bytes(view[offsets[i] : offsets[i + 1]]), least).items():
                    digests.append(xxhash.xxh3_128_digest(key))
                    row.append(i)
                    lines.append(at)
            if row:
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                own = [batch.column(c).take(pa.array(row, pa.int32())) for c in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), *own, pa.array(lines, _TYPES[-1])], names=_NAMES)

    return docs.select("doc_id", "text", "k1", "k2").mapInArrow(run, _ENTRY)


class Runs:
    """The rows of a range as they come, sorted by key, document from the largest down, and row."""

    def __init__(self, documents: int):
        self.least, self.key, self.opened, self.out = documents, None, True, []

    def add(self, row: tuple) -> None:
        key, doc, mark = row[:2], row[2], row[2:5]
        if key != self.key:
            first = self.key is None
            self.close()
            # a range's first key may have begun in another one
            self.key, self.opened, self.held, self.seen, self.top, self.mark = key, first, [], 0, doc, None
        if mark == self.mark:
            return
        if not self.seen or doc != self.mark[0]:
            self.seen += 1
        self.mark = mark
        if self.opened:
            self.out.append((OPEN, *row, None, None))
        elif self.seen >= self.least:
            self.out += [(GOES, *r, None, None) for r in (*self.held, row)]
            self.held = []
        elif self.seen > 1:
            self.held.append(row)
            if len(self.held) > HELD:
                self._open()

    def _open(self) -> None:
        self.out += [(OPEN, *r, None, None) for r in self.held]
        self.held, self.opened = [], True

    def close(self, last: bool = False) -> None:
        """Ends a key; that of a range's end may go on in the next."""
        if last and self.key is not None and not self.opened:
            self._open()
        if self.key is not None and self.opened:
            self.out.append((TOTAL, *self.key, self.top, None, None, None, self.mark[0], self.seen))


def judged(ordered: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """Rows of entries that go (kind GOES), that another range decides (OPEN), and what a range knows of such keys (TOTAL: doc_id is its first document, last its last, n how many)."""
    names = ["kind", *_NAMES, "last", "n", "range"]
    types = [pa.int8(), *_TYPES, pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, own = Runs(documents), TaskContext.get().partitionId()

        def made() -> pa.RecordBatch:
            columns = [*zip(*runs.out, strict=True), [own] * len(runs.out)]
            runs.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            if not len(batch):
                continue
            h1, h2 = (batch.column(c).to_numpy() for c in (0, 1))
            begins = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            sizes = np.diff(np.append(begins, len(batch)))
            # a key with one row inside a batch stands in one document: most do
            many = sizes > 1
            many[0] = many[-1] = True
            take = pa.array(np.flatnonzero(np.repeat(many, sizes)), pa.int64())
            for row in zip(*[c.take(take).to_pylist() for c in batch.columns], strict=True):
                runs.add(row)
            if runs.out:
                yield made()
        runs.close(last=True)
        if runs.out:
            yield made()

    kinds = "kind byte, " + _ENTRY + ", last long, n long, range int"
    return ordered.select(*_NAMES).mapInArrow(run, kinds)


def dropped(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(k1, k2, lines) of entries whose lines go, of docs (doc_id, text, k1, k2)."""
    found = store(entries(docs, least), "lines")  # dealing by ranges reads its input twice
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "k1", "k2"]
    told = store(judged(found.repartitionByRange(*order).sortWithinPartitions(*order), documents), "judged")
    # a key that stands in several ranges: a document at the end of one may begin the next
    before = Window.partitionBy("h1", "h2").orderBy("range")
    shared = told.where(F.col("kind") == TOTAL).withColumn("again", F.lag("last").over(before).eqNullSafe(F.col("doc_id")) & (F.row_number().over(before) > 1))
    totals = shared.groupBy("h1", "h2").agg(F.sum(F.col("n") - F.col("again").cast("long")).alias("all"), F.min_by(F.struct("doc_id"), "range").alias("top"))
    totals = totals.where(F.col("all") >= documents)
    late = told.where(F.col("kind") == OPEN).join(F.broadcast(totals), ["h1", "h2"])  # two rows a range, and one for each HELD rows of a key
    late = late.where(~F.col("doc_id").eqNullSafe(F.col("top.doc_id")))
    return told.where(F.col("kind") == GOES).select("k1", "k2", "lines").unionByName(late.select("k1", "k2", "lines"))


def bitmap(gone: list[int]) -> bytes:
    """Bits of the lines up to the last that goes, in whole bytes, 1 where a line stays, deflated."""
    bits = np.ones(-(-(max(gone) + 1) // 8) * 8, np.uint8)
    bits[gone] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 6, wbits=-15)


def stays(keep: bytes, n: int) -> np.ndarray:
    """Which of n lines a bitmap keeps; those beyond its end stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep, wbits=-15), np.uint8))
    return np.append(bits, np.ones(max(0, n - len(bits)), np.uint8))[:n]


def keep_bitmaps(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(k1, k2, keep) of the rows of docs (doc_id, text, k1, k2) that lose lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bitmap(gone) for gone in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["k1", "k2", "keep"])

    def build() -> DataFrame:
        # as many numbers as the document has lines at most
        own = dropped(docs, least, documents).groupBy("k1", "k2").agg(F.flatten(F.collect_list("lines")).alias("gone"))
        return own.mapInArrow(run, "k1 long, k2 long, keep binary")

    return settled(docs.sparkSession, "bitmaps", build)


def with_keep(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """docs with a last column, the bitmap of the lines that stay (null: all)."""
    keys = [unused(c, docs.columns) for c in ("_k1", "_k2")]
    keep = unused("_keep", docs.columns)
    keyed = docs.select("*", row_key("doc_id", "text").alias(keys[0]), row_key("text", "doc_id", seed=1).alias(keys[1]))
    own = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(keys[0]).alias("k1"), F.col(keys[1]).alias("k2"))
    maps = keep_bitmaps(own, least, documents).select(F.col("k1").alias(keys[0]), F.col("k2").alias(keys[1]), F.col("keep").alias(keep))
    small = bounded(maps, BITMAPS) and (maps.agg(F.sum(F.length(keep))).first()[0] or 0) <= BITMAP_BYTES
    return keyed.join(F.broadcast(maps) if small else maps, keys, "left").select(*[keyed[c] for c in docs.columns], keep)


def _kept(raw: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """(lines, lines that go, what stays)."""
    if keep is None:
        return raw.count(b"\n") + 1, 0, raw
    lines = raw.split(b"\n")
    own = stays(keep, len(lines))
    return len(lines), len(lines) - int(own.sum()), b"\n".join([x for x, k in zip(lines, own.tolist(), strict=True) if k])


def digests(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(1))
            view, out = memoryview(data), []
            for i, keep in enumerate(batch.column(2).to_pylist()):
                n, gone, kept = _kept(bytes(view[offsets[i] : offsets[i + 1]]), keep)
                out.append((n, gone, hashlib.sha256(kept).hexdigest()))
            made = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    marked = with_keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least, documents)
    return marked.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def remove_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """docs without the lines that go; null texts stay null, other columns as they are, but n_chars, where there is one, follows the text."""
    columns, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(at))
            view, texts = memoryview(data), batch.column(at)
            if batch.column(len(columns)).null_count < len(batch):
                own = [_kept(bytes(view[offsets[i] : offsets[i + 1]]), keep)[2].decode("utf-8", "replace") for i, keep in enumerate(batch.column(len(columns)).to_pylist())]
                texts = pa.array(own, pa.string(), mask=np.asarray(texts.is_null()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 : -1]], names=columns)

    out = with_keep(docs, least, documents).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
