"""BPE encoding and decoding with a tokenizers-library vocabulary of word-end pieces.

Encoding follows the contiguous-rank-array scheme: a word is an array of parts next to
an array with the merge rank of every adjacent pair; the smallest rank is searched by a
scan, that boundary is deleted, and the two neighbouring ranks are looked up again.
Words longer than SHORT parts go through a heap of pairs, which gives the same merges
(smallest rank, leftmost first) without the quadratic scan.

Null text counts as empty: no ids. Every other text is encoded whole, whatever its length,
in time linear in it but for the heap's logarithm; a word of any length is one word. Of
equal ranks the leftmost pair merges first. Repeated rows come out alike, other columns
play no part or stay as they are, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices

#: Words of more parts than this are merged with a heap.
SHORT = 128
#: Entries in each generation of a word cache, which bounds a worker's memory.
CACHED = 150_000
_NONE = 1 << 60
assert sys.byteorder == "little" and array("I").itemsize == 4
#: White space as the vocabulary's own splitter sees it (fixed values).
_SPACE = "\t-\r \x85\xa0  -     　"
#: Control characters that str.split() drops although the splitter keeps them.
_ODD = regex.compile("[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in kept}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(kept))
    return [table[b] for b in range(256)]


def merge_short(ids: list[int], rank_of: dict[int, int], made: list[int]) -> list[int]:
    """Merges by repeated scans over a contiguous array of adjacent ranks."""
    look = rank_of.get
    ranks = [look(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
    while ranks:
        least = min(ranks)
        if least == _NONE:
            break
        at = ranks.index(least)
        ids[at] = made[least]
        del ids[at + 1], ranks[at]
        if at:
            ranks[at - 1] = look(ids[at - 1] << 32 | ids[at], _NONE)
        if at < len(ranks):
            ranks[at] = look(ids[at] << 32 | ids[at + 1], _NONE)
    return ids


def merge_long(ids: list[int], rank_of: dict[int, int], made: list[int]) -> list[int]:
    """The same merges from a heap of pairs over linked parts, for very long words."""
    n = len(ids)
    after, before, look = [*range(1, n), -1], [-1, *range(n - 1)], rank_of.get
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := look(ids[i] << 32 | ids[i + 1], _NONE)) != _NONE]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j] = made[rank], -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (r := look(ids[i] << 32 | ids[k], _NONE)) != _NONE:
                heapq.heappush(heap, (r, i, ids[i], ids[k]))
        h = before[i]
        if h >= 0 and (r := look(ids[h] << 32 | ids[i], _NONE)) != _NONE:
            heapq.heappush(heap, (r, h, ids[h], ids[i]))
    return [x for x in ids if x >= 0]


class _Cache(dict):
    """Remembers make(key) in two generations: a full one becomes the older, and the one before goes."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBPE:
    """Encoder and decoder of a lower-casing BPE vocabulary with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = token
        self.token_bytes = [t.encode() for t in self.tokens]
        self.special = special
        self.split_special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.alphabet = byte_alphabet()
        self.inner = [vocab.get(c) for c in self.alphabet]
        self.last = [vocab.get(c + self.end) for c in self.alphabet]
        self.rank_of, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", _SPACE)).findall
        self.between = regex.compile(f"[{_SPACE}]+").split
        self.piece_ids = _Cache(self._piece)
        self.word_ids = _Cache(self._word)

    def _piece(self, piece: str) -> bytes:
        raw, inner = piece.encode(), self.inner
        ids = [inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        return array("I", (merge_short if len(ids) <= SHORT else merge_long)(ids, self.rank_of, self.made)).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii():
            text = word.lower()
            if word.isalpha() and len(word) <= 64:
                return self.piece_ids[text]
        else:
            text = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        return b"".join([self.piece_ids[p] if len(p) <= 64 else self._piece(p) for p in self.pieces(text)])

    def _plain(self, text: str) -> bytes:
        words = text.split() if not _ODD.search(text) else [w for w in self.between(text) if w]
        return b"".join([self.word_ids[w] if len(w) <= 256 else self._word(w) for w in words])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_special is None or "<" not in text:
            return self._plain(text)
        parts = self.split_special.split(text)
        return b"".join([np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in parts])

    def decode(self, ids: bytes) -> bytes:
        """The pieces of the ids with spaces between, in UTF-8 (this vocabulary names no decoder)."""
        return b" ".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def load(path: str) -> WordBPE:
    return WordBPE(path)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with a binary column of little-endian unsigned 32-bit ids of the whole text."""
    return _mapped(docs, text, lambda bpe, value: (bpe.encode(value),), [pa.field(ids, pa.binary())], f"{ids} binary", vocabulary)


def decode(frame: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """frame with the text of a binary id column; null ids are empty."""
    return _mapped(frame, ids, lambda bpe, value: (bpe.decode(value or b"").decode(),), [pa.field(text, pa.string())], f"{text} string", vocabulary)


def digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """docs without its text, with n_tokens and SHA-256 digests of ids and of the decoded text."""

    def digest(bpe: WordBPE, value: str | None) -> tuple:
        ids = bpe.encode(value)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()

    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _mapped(docs, text, digest, fields, "n_tokens long, ids_sha256 string, decoded_sha256 string", vocabulary, drop=(text,))


def _mapped(frame: DataFrame, column: str, one, fields: list, ddl: str, vocabulary: str, drop: tuple = ()) -> DataFrame:
    """frame with columns computed from one column; columns of the same names are replaced."""
    new = [f.name for f in fields]
    kept = [c for c in frame.columns if c not in new and c not in drop]
    source = frame.select(*[frame[c] for c in dict.fromkeys([*kept, column])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in slices(batches, column):
            values = [one(bpe, v) for v in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            made = [pa.array([v[i] for v in values], f.type) for i, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], *made], names=[*kept, *new])

    head = source.select(*kept).schema
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in head], ddl])
    return source.mapInArrow(run, schema)
