"""Fill-in-the-middle: a text cut in three and put together anew, by one scan of a byte automaton.

The automaton is a table: six states by 256 bytes. It knows the bytes of a character that
are still to come, and how much of a sentinel has been read; each transition tells whether
a character begins and whether a sentinel ends there, and a scan adds these up. Texts are
scanned in stretches of STRETCH bytes, all stretches of a batch a byte at a time together:
a state depends on three bytes at most, so a stretch in the middle of a text begins three
bytes early. The second pass scans again the stretches in which a text is cut, up to where
the count reaches the cut. Texts are never decoded.

Defined results: null is the empty text, and the empty text stays plain. A row without
doc_id is numbered by the empty string. Texts of any length are scanned whole; repeated
rows come out alike; columns of docs with the names of the results are replaced, others
stay. A byte that can't continue a character begins one. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import slices

#: Sentinels, all of one form: before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts those that are changed, and of 100 of these those with the suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
#: Bytes of a stretch; bytes of texts that are scanned together.
STRETCH, TOGETHER = 1024, 4 << 20

_OWN = ["n", "form", "output", "prefix_chars", "middle_chars"]
_SEED = b"1:"

# states: between characters; one, two or three bytes to come; "<" read; "<" and a letter read
_READY, _TAIL, _OPEN, _NAMED = 0, 1, 4, 5
#: What a transition counts: a character in the low half, a sentinel in the high one.
_CHARACTER, _SENTINEL = 1, 1 << 32


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, count) by state * 256 + byte."""
    step, count = np.zeros((6, 256), np.uint8), np.full((6, 256), _CHARACTER, np.int64)
    letters = [s[1] for s in (PREFIX, SUFFIX, MIDDLE)]
    for state in range(6):
        step[state, 0xC0:0xE0], step[state, 0xE0:0xF0], step[state, 0xF0:] = _TAIL, _TAIL + 1, _TAIL + 2
        step[state, ord("<")] = _OPEN
    for state in range(_TAIL, _TAIL + 3):
        step[state, 0x80:0xC0], count[state, 0x80:0xC0] = state - 1, 0
    step[_OPEN, letters] = _NAMED
    count[_NAMED, ord(">")] += _SENTINEL
    return step.ravel(), count.ravel()


_STEP, _COUNT = automaton()


def _scan(data: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray, goal: np.ndarray | None = None) -> np.ndarray:
    """The counts of stretches of data (longest first); with goal, the place where each has counted that many characters and the next begins, -1 where it has fewer."""
    total, place = np.zeros(len(begin), np.int64), np.full(len(begin), -1, np.int64)
    left = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # stretches longer than so many bytes
    for j, n in enumerate(left.tolist()):
        at = state[:n].astype(np.int64) * 256 + data[begin[:n] + j]
        state[:n] = _STEP[at]
        made = _COUNT[at]
        if goal is not None:
            here = (total[:n] == goal[:n]) & (made > 0) & (place[:n] < 0)
            place[:n][here] = begin[:n][here] + j
            made = made & (_SENTINEL - 1)
        total[:n] += made
    return total if goal is None else place


def _ready(data: np.ndarray, begin: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The state before each stretch; inner ones have three bytes of their text before them."""
    state = np.zeros(len(begin), np.uint8)
    for back in (3, 2, 1):
        state[inner] = _STEP[state[inner].astype(np.int64) * 256 + data[begin[inner] - back]]
    return state


class Scanned:
    """Texts of a batch: how many characters each has, whether it holds a sentinel, where characters begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        size = np.diff(offsets)
        parts = np.maximum(1, -(-size // STRETCH))
        self.data, self.offsets, self.first = data, offsets, np.append(0, np.cumsum(parts))
        text = np.repeat(np.arange(len(size)), parts)
        part = np.arange(len(text)) - self.first[text]
        self.begin, self.inner = offsets[text] + part * STRETCH, part > 0
        self.size = np.minimum(STRETCH, offsets[text + 1] - self.begin)
        count = self._by_length(np.arange(len(text)))
        units = count & (_SENTINEL - 1)
        self.before = np.append(0, np.cumsum(units))  # characters before a stretch, over all texts
        self.n = self.before[self.first[1:]] - self.before[self.first[:-1]]
        self.marked = np.add.reduceat(count >> 32, self.first[:-1]) > 0 if len(size) else np.zeros(0, bool)

    def _by_length(self, which: np.ndarray, goal: np.ndarray | None = None) -> np.ndarray:
        order = np.argsort(-self.size[which], kind="stable")
        own = which[order]
        out = np.empty(len(which), np.int64)
        out[order] = _scan(self.data, self.begin[own], self.size[own], _ready(self.data, self.begin[own], self.inner[own]), None if goal is None else goal[order])
        return out

    def places(self, text: np.ndarray, character: np.ndarray) -> np.ndarray:
        """Where the given character of a text begins, its end if it has no more."""
        goal = self.before[self.first[text]] + character
        which = np.searchsorted(self.before, goal, side="right") - 1
        out = self.offsets[text + 1].copy()
        more = character < self.n[text]
        out[more] = self._by_length(which[more], (goal - self.before[which])[more])
        return out


def draws(doc_id: int | None) -> tuple[int, ...]:
    """The four numbers that decide a document's cuts and form."""
    digest = hashlib.sha256(_SEED + (b"" if doc_id is None else b"%d" % doc_id)).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])


def parted(form: str, output: bytes) -> bytes:
    """The text that an output of a form was made of; its parts hold no sentinel."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX, 1)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX, 1)
    return prefix + middle + suffix


def _text(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def transform(docs: DataFrame) -> DataFrame:
    """docs with n, form (plain, psm or spm), output, prefix_chars and middle_chars (code points; null if plain)."""
    kept = [c for c in docs.columns if c.lower() not in _OWN]
    at, key = kept.index("text"), kept.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TOGETHER):
            data, offsets = kernels.flat(batch.column(at))
            found, view = Scanned(data, offsets), memoryview(data)
            drawn = np.array([draws(k) for k in batch.column(key).to_pylist()], np.int64).reshape(-1, 4)
            cuts = np.sort(drawn[:, :2] % (found.n[:, None] + 1), axis=1)
            plain = (found.n == 0) | found.marked | (drawn[:, 2] % 100 >= CHANGED)
            form = np.where(plain, "plain", np.where(drawn[:, 3] % 100 < SUFFIX_FIRST, "spm", "psm")).tolist()
            changed = np.flatnonzero(~plain)
            ends = [found.places(changed, cuts[changed, k]) for k in (0, 1)]
            made = [bytes(view[offsets[i] : offsets[i + 1]]) if plain[i] else b"" for i in range(len(batch))]
            for i, a, b in zip(changed.tolist(), ends[0].tolist(), ends[1].tolist(), strict=True):
                made[i] = joined(form[i], view[offsets[i] : a], view[a:b], view[b : offsets[i + 1]])
            sizes = [pa.array(x, pa.int64(), mask=plain) for x in (cuts[:, 0], cuts[:, 1] - cuts[:, 0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.n, pa.int64()), pa.array(form, pa.string()), _text(made), *sizes], names=[*kept, *_OWN])

    own = docs.select(*kept)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema], "n long, form string, output string, prefix_chars long, middle_chars long"])
    return own.mapInArrow(run, schema)


def restore(rows: DataFrame) -> DataFrame:
    """rows (form, output, ...) with restored, the text that each output was made of."""
    names = [c for c in rows.columns if c.lower() != "restored"]
    form, output = names.index("form"), names.index("output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output", TOGETHER):
            data, offsets = kernels.flat(batch.column(output))
            view = memoryview(data)
            made = [parted(f, bytes(view[offsets[i] : offsets[i + 1]])) for i, f in enumerate(batch.column(form).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, _text(made)], names=[*names, "restored"])

    own = rows.select(*names)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema], "restored string"])
    return own.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of each row of docs (doc_id, text)."""
    made = restore(transform(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")])
