"""Vectorised work on whole columns of text: words, their hashes, windows of words.

Texts stay UTF-8 bytes end to end. A word is a run of bytes other than \\x20 and
\\x09-\\x0D. Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from .common import bytes_of

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a range that are hashed with numpy; what follows goes through blake2b.
_LONG = 512
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _BACK)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i], times base^-i, a rolling hash of data[i:j].

    Equal bytes have equal hashes; unequal ones may be made to (sums modulo 2^64), so it
    chooses places only and never decides that bytes are equal.
    """
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=out[1:])
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column, gapless from 0; nulls are empty."""
    raw, starts, ends = bytes_of(column)
    if len(starts) and (starts[1:] == ends[:-1]).all():
        return raw[starts[0] : ends[-1]], np.append(starts, ends[-1]) - starts[0]
    parts = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    return np.concatenate([np.zeros(0, np.uint8), *parts]), np.append(0, np.cumsum(ends - starts))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words in order, and where each text's words begin among them."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[:1], after[-1:] = False, False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range: eight at a time, each block mixed into all before it.

    Every step is a bijection of the block for given bytes before it, and no step is
    linear, so texts that repeat by a rule do not cancel out as they do in sums of powers.
    """
    length = ends - starts
    out = mix(length.astype(np.uint64) + _BASE)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    live, at = np.flatnonzero(length > 0), 0
    while len(live) and at < _LONG:
        block = eight[starts[live] + at] & _FIRST[np.minimum(length[live] - at, 8)]
        out[live] = mix((out[live] ^ block) * _BASE + np.uint64(at + 1))
        at += 8
        live = live[length[live] > at]
    for i in live.tolist():  # few ranges are that long
        rest = hashlib.blake2b(data[starts[i] + at : ends[i]], digest_size=8, key=int(out[i]).to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(rest, "little")
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, at) of every run of `width` words within a text; at is the run's first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[k : k + n]
    return mix(out[at]), at


def totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring offsets; floats are added up within each, whatever stands around it."""
    if values.dtype.kind == "f":
        out, filled = np.zeros(len(offsets) - 1), np.flatnonzero(np.diff(offsets))
        if len(filled):
            out[filled] = np.add.reduceat(values, offsets[filled])
        return out
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


class HashArrays:
    """Values by 64-bit key, in arrays sorted by hash with a directory over the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        hashes = mix(keys.astype(np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.values, self.missing = hashes[order], values[order], missing
        self.shift = np.uint64(64 - max(4, min(22, int(len(keys)).bit_length())))
        tops = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64)
        self.directory = np.append(np.searchsorted(self.hashes, tops << self.shift), len(keys)).astype(np.int32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(keys), self.missing, self.values.dtype)
        hashes = mix(keys)
        at = self.directory[(hashes >> self.shift).astype(np.int32)]
        last = len(self.hashes) - 1
        np.minimum(at, last, out=at)
        short = np.flatnonzero(self.hashes[at] < hashes)
        while len(short):
            at[short] += 1
            short = short[at[short] <= last]
            short = short[self.hashes[at[short]] < hashes[short]]
        np.minimum(at, last, out=at)
        out = self.values[at]
        out[self.hashes[at] != hashes] = self.missing
        return out
