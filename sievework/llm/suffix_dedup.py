"""Removal of repeated byte strings with anchored suffix arrays, sorted deep-shallow.

A byte goes when it lies in a string of `length` bytes that also starts somewhere else.
Every such string holds an anchor that its bytes alone decide: the leftmost `gram`-byte
window of least hash in it. So equal strings have equal anchors at equal places, and it
is enough to compare strings around anchors that occur more than once. The suffixes
from an anchor rightward, and the reversed ones leftward, are put in suffix arrays:
multikey quicksort on 8-byte characters down to a shallow depth, then blind (Patricia)
tries for the groups whose common prefix goes on. Common prefixes of neighbours in the
two arrays say at which distances before the anchor a string of `length` bytes recurs.

Work per anchor is on distinct contexts: equal ones (compared byte by byte) are one, with
a count, before the shuffle. Where a third of all documents share a passage, each task
sends it once. An anchor with very many contexts is split: strings that start STEP or
fewer bytes apart before their anchors have all bytes between in common, so contexts meet
in parts by the digest of those bytes, each part with its own suffix arrays. A part that
is still too large (very many surroundings of one passage) is taken string by string:
128-bit digests of its strings are counted by Spark, whatever their number.

Texts are judged whole, as UTF-8, on the input, however long; matches never cross
documents. Null is empty. Rows equal in doc_id and text share a key: both are searched
and both lose what repeats. Rows of one doc_id with different texts are told apart. Other
columns stay as they are, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import bounded, has_rows, join_hot, row_key, settled, slices, store, unused

LENGTH = 400
GRAM = 200
#: Bytes sorted by multikey quicksort before blind tries take over.
SHALLOW = 32
#: Bits of a place in a batch; a hash's other bits choose the anchor, the same ones in batches of all sizes.
PLACE_BITS = np.uint64(32)
#: Bits of the filter of repeated anchors at most (32 MB).
FILTER_BITS = 1 << 28
#: Rows of removed ranges that are broadcast at most.
RANGES = 400_000
#: Contexts (as sent by tasks) from which an anchor, and then a part of it, is split, and distances in a part.
CROWD, STEP = 1_000, 25


# ---------------------------------------------------------------- sorting


def common_prefix(a: bytes, b: bytes, begin: int = 0) -> int:
    """Length of the common prefix of a and b, which agree up to begin."""
    n = min(len(a), len(b))
    step = 64
    while begin < n:
        x, y = a[begin : min(n, begin + step)], b[begin : min(n, begin + step)]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return begin + len(x) - (differ.bit_length() + 7) // 8
        begin += step
        step *= 4
    return n


class _Node:
    __slots__ = ("depth", "kids", "ends", "rep")

    def __init__(self, depth: int, ends: list[int], rep: int):
        self.depth, self.kids, self.ends, self.rep = depth, {}, ends, rep


def blind_trie(strings: list[bytes], group: list[int], depth: int) -> list[int]:
    """group, all equal up to depth, in order: a Patricia trie that is searched blindly.

    A search looks at branching bytes only; the string it ends at then shows the true
    common prefix, and with it where the new string belongs.
    """
    root: _Node | None = None
    for i in group:
        s = strings[i]
        if root is None:
            root = _Node(len(s), [i], i)
            continue
        path = [root]
        while path[-1].depth < len(s) and (kid := path[-1].kids.get(s[path[-1].depth])):
            path.append(kid)
        t = strings[path[-1].rep]
        same = common_prefix(s, t, depth)
        k = next(k for k, node in enumerate(path) if node.depth >= same)
        node = path[k]
        if node.depth > same:
            split = _Node(same, [], node.rep)
            split.kids[t[same]] = node
            if k:
                path[k - 1].kids[s[path[k - 1].depth]] = split
            else:
                root = split
            node = split
        if len(s) == same:
            node.ends.append(i)
        else:
            node.kids[s[same]] = _Node(len(s), [i], i)
    out: list[int] = []
    stack = [root] if root else []
    while stack:
        node = stack.pop()
        out += node.ends
        stack += [node.kids[b] for b in sorted(node.kids, reverse=True)]
    return out


def suffix_array(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(order, lcp): strings sorted deep-shallow, and common prefixes with the one before (0 first)."""
    order: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            order += group
        elif depth >= SHALLOW:
            order += blind_trie(strings, group, depth)
        else:
            keys = [strings[i][depth : depth + 8] for i in group]
            pivot = sorted(keys[:: max(1, len(keys) // 9)])[len(keys[:: max(1, len(keys) // 9)]) // 2]
            below = [i for i, k in zip(group, keys, strict=True) if k < pivot]
            equal = [i for i, k in zip(group, keys, strict=True) if k == pivot]
            above = [i for i, k in zip(group, keys, strict=True) if k > pivot]
            stack.append((above, depth))
            # strings that end here are equal: nothing is left to sort among them
            stack += [([i], depth) for i in reversed(equal)] if len(pivot) < 8 else [(equal, depth + 8)]
            stack.append((below, depth))
    lcp = [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    return order, lcp


# ---------------------------------------------------------------- anchors


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, at, low, high) of each anchor: it decides the windows that start from low to high."""
    width = length - gram + 1
    n = len(data) - gram + 1
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    sums = kernels.prefix_hashes(data)
    hashes = kernels.mix((sums[gram:] - sums[:n]) * kernels.powers(len(data) + 1)[1][:n])
    least = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(n, dtype=np.uint64)
    # sliding minimum: of any window, the end of one block and the beginning of the next
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = least
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(data) - length + 1
    at = (np.minimum(after[:starts], before[width - 1 : width - 1 + starts]) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    room = np.maximum(np.diff(offsets) - length + 1, 0)
    first = np.append(0, np.cumsum(room))
    if not first[-1]:
        return none
    text = np.repeat(np.arange(len(room)), room)
    p = np.arange(first[-1]) - np.repeat(first[:-1] - offsets[:-1], room)
    at = at[p]
    new = np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(p)) - 1
    return text[begin], hashes[at[begin]], at[begin], p[begin], p[end]


def _sorted_counts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.sort(hashes)
    at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[at], np.diff(np.append(at, len(hashes)))


def repeated_anchors(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """A bit per hash value modulo its size; set for all anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            h, n = _sorted_counts(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

        for batch in slices(batches, "text"):
            held.append(anchors(*kernels.flat(batch.column(0)), length, gram)[1])
            size += len(held[-1])
            if size > 1_000_000:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    counts = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    repeated = store(counts.where("n > 1").select("h"), "anchors")
    bits = 1 << 16
    while bits < min(FILTER_BITS, 64 * repeated.count()):
        bits *= 2
    spot = F.col("h").bitwiseAND(bits - 1)
    one = F.expr("shiftleft(1L, cast(h & 63 as int))")
    got = repeated.groupBy(F.shiftright(spot, 6).alias("word")).agg(F.bit_or(one).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got.column("word").to_numpy()] = got.column("set").to_numpy().view(np.uint64)
    return out


_CONTEXT = "h long, ctx binary, n long, left int, low int, body binary, places binary"
_PLACE = np.dtype([("doc", "<i8"), ("at", "<i4")])


def contexts(docs: DataFrame, bits: np.ndarray, length: int, gram: int) -> DataFrame:
    """Distinct contexts of repeated anchors, with the places (document, anchor) that have them, per task.

    A context is the union of the windows its anchor decides; left is the anchor's place
    in it, low the least distance from a window's start to the anchor.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        mask = np.uint64(len(table) * 64 - 1)
        held: dict[tuple[bytes, int], list] = {}  # by bytes and the anchor's place in them
        size = 0

        def rows() -> pa.RecordBatch:
            v = list(held.items())
            places = [np.array(x[2], _PLACE).tobytes() for _, x in v]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for _, x in v], pa.int64()), pa.array([_digest(*k) for k, _ in v], pa.binary()), pa.array([len(x[2]) for _, x in v], pa.int64()), pa.array([k[1] for k, _ in v], pa.int32()), pa.array([x[1] for _, x in v], pa.int32()), pa.array([k[0] for k, _ in v], pa.binary()), pa.array(places, pa.binary())],
                names=["h", "ctx", "n", "left", "low", "body", "places"],
            )

        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(0))
            text, h, at, low, high = anchors(data, offsets, length, gram)
            spot = h & mask
            hit = np.flatnonzero(table[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1))
            if not len(hit):
                continue
            text, h, at, low, high = text[hit], h[hit].view(np.int64), at[hit], low[hit], high[hit]
            doc = np.asarray(batch.column(1))[text]
            raw = data.tobytes()
            for h_, d, w, a, b, c in zip(h.tolist(), doc.tolist(), (at - offsets[text]).tolist(), low.tolist(), (high + length).tolist(), at.tolist(), strict=True):
                key = raw[a:b], c - a
                own = held.get(key)
                if own is None:
                    held[key] = [h_, c - b + length, [(d, w)]]
                    size += b - a + 200
                else:
                    own[2].append((d, w))
                    size += 100
            if size > 8 << 20:
                yield rows()
                held, size = {}, 0
        if held:
            yield rows()

    return docs.select("text", "key").mapInArrow(run, _CONTEXT)


def _digest(body: bytes, left: int) -> bytes:
    """128 bits of a context: its bytes and the anchor's place in them."""
    return hashlib.blake2b(body, digest_size=16, salt=left.to_bytes(8, "little")).digest()


# ---------------------------------------------------------------- what recurs


def recurring(bodies: list[bytes], left: list[int], low: list[int], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each distinct context of an anchor, ranges of distances o (both ends in) at which its string recurs.

    The string at distance o starts o bytes before the anchor. Contexts i and j have the
    same one if o bytes to the left and length - o to the right agree.
    """
    m = len(bodies)
    whole = [[(low[i], left[i])] if counts[i] > 1 else [] for i in range(m)]
    if m < 2:
        return whole
    right_order, right_lcp = suffix_array([b[k:] for b, k in zip(bodies, left, strict=True)])
    left_order, left_lcp = suffix_array([b[:k][::-1] for b, k in zip(bodies, left, strict=True)])
    if m <= 24:
        left_rank = {i: r for r, i in enumerate(left_order)}
        for r, i in enumerate(right_order):
            right = length
            for s in range(r + 1, m):
                right = min(right, right_lcp[s])
                j = right_order[s]
                begin = max(length - right, low[i], low[j])
                if right < length - min(left[i], left[j]):
                    break_all = right < length - max(left)
                    if break_all:
                        break
                    continue
                a, b = sorted((left_rank[i], left_rank[j]))
                end = min(min(left_lcp[a + 1 : b + 1]), left[i], left[j])
                if begin <= end:
                    whole[i].append((begin, end))
                    whole[j].append((begin, end))
        return [_merged(x) for x in whole]
    r_lcp, l_lcp, lows, lefts, n = (np.array(x) for x in (right_lcp, left_lcp, low, left, counts))
    turns = np.unique(np.concatenate([length - r_lcp, l_lcp + 1, lows, lefts + 1, [0]]))
    turns = turns[(turns >= 0) & (turns <= lefts.max())]
    ids = np.empty((2, m), np.int64)
    for o, stop in zip(turns.tolist(), [*(turns[1:] - 1).tolist(), int(lefts.max())], strict=True):
        ids[0][right_order] = np.cumsum(r_lcp < length - o)
        ids[1][left_order] = np.cumsum(l_lcp < o)
        own = np.flatnonzero((lows <= o) & (o <= lefts))
        if not len(own):
            continue
        pair = ids[0][own] * (m + 1) + ids[1][own]
        _, of, times = np.unique(pair, return_inverse=True, return_counts=True)
        for i in own[times[of] > 1].tolist():
            if n[i] < 2:
                whole[i].append((o, stop))
    return [_merged(x) for x in whole]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def verdicts(found: DataFrame, length: int) -> DataFrame:
    """(ctx, ranges) of contexts with a string that recurs; ranges are pairs of 16-bit distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, {}
        out, blobs = [], []

        def close() -> None:
            if len(group) == 1 and next(iter(group.values()))[0] < 2:
                return
            v = list(group.values())
            got = recurring([x[3] for x in v], [x[1] for x in v], [x[2] for x in v], [x[0] for x in v], length)
            for ctx, ranges in zip(group, got, strict=True):
                if ranges:
                    out.append(ctx)
                    blobs.append(np.array(ranges, "<u2").tobytes())

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(blobs, pa.binary())], names=["ctx", "ranges"])
            out.clear()
            blobs.clear()
            return made

        for batch in batches:
            for h, ctx, n, left, low, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if h != now:
                    if group:
                        close()
                    now, group = h, {}
                own = group.setdefault(ctx, [0, left, low, body])
                if own[3] != body:
                    raise ArithmeticError("two different contexts share a digest")
                own[0] += n
            yield rows()
        if group:
            close()
        yield rows()

    dealt = found.select(*_PART).repartition("h").sortWithinPartitions("h", "ctx")
    return dealt.mapInArrow(run, "ctx binary, ranges binary")


_PART = ["h", "ctx", "n", "left", "low", "body"]
_PARTS = "h long, ctx binary, n long, left int, low int, body binary"


def crowded(found: DataFrame, crowd: int) -> DataFrame | None:
    """The anchors (h) of more than `crowd` rows of found; None if there are none."""
    crowds = store(found.groupBy("h").agg(F.count("*").alias("rows")).where(F.col("rows") > crowd).select("h"), "crowds")
    if not has_rows(crowds):
        return None
    # rows are shared among crowds, so there are few; beyond the bound the join shuffles
    return F.broadcast(crowds) if bounded(crowds, 1_000_000) else crowds


def in_parts(found: DataFrame, length: int, step: int = STEP) -> DataFrame:
    """Contexts cut to `step` distances each; the key of a part is the anchor, its distances, and the digest of the bytes that a string at any of them holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, ctx, n, left, low, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for begin in range(low - low % step, left + 1, step):
                    a, b = max(low, begin), min(left, begin + step - 1)
                    core = body[left - begin : left + length - (begin + step - 1)]
                    key = int.from_bytes(hashlib.blake2b(core, digest_size=8, key=(h & (1 << 64) - 1).to_bytes(8, "big"), salt=begin.to_bytes(4, "big")).digest(), "big", signed=True)
                    out.append((key, ctx, n, b, a, body[left - b : left + length - a]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=_PART)

    return found.select(*_PART).mapInArrow(run, _PARTS)


def by_string(found: DataFrame, length: int) -> DataFrame:
    """(ctx, ranges) of contexts, each of whose strings is compared with all others by its 128-bit digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for _, ctx, n, left, low, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out += [(ctx, n, o, hashlib.blake2b(body[left - o : left - o + length], digest_size=16).digest()) for o in range(low, left + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int32(), pa.binary()))], names=["ctx", "n", "o", "string"])

    each = store(found.select(*_PART).mapInArrow(run, "ctx binary, n long, o int, string binary"), "strings")
    twice = store(each.groupBy("string").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).where("n > 1").select("string", "rows"), "twice")
    hits = join_hot(each.select("ctx", "o", "string"), twice, "string", "rows", "inner").select("ctx", "o").distinct()
    # a pair of equal little-endian 16-bit ends for each distance
    end = F.concat(F.unhex(F.substring(F.lpad(F.hex("o"), 4, "0"), 3, 2)), F.unhex(F.substring(F.lpad(F.hex("o"), 4, "0"), 1, 2)))
    return hits.select("ctx", F.concat(end, end).alias("ranges"))


def all_verdicts(found: DataFrame, length: int, crowd: int = CROWD, step: int = STEP) -> DataFrame:
    """(ctx, ranges), several rows a context where its anchor is split."""
    crowds = crowded(found, crowd)
    if crowds is None:
        return verdicts(found, length)
    parts = store(in_parts(found.join(crowds, "h", "left_semi"), length, step), "parts")
    out = verdicts(found.join(crowds, "h", "left_anti"), length)
    large = crowded(parts, crowd)
    if large is None:
        return out.unionByName(verdicts(parts, length))
    return out.unionByName(verdicts(parts.join(large, "h", "left_anti"), length)).unionByName(by_string(parts.join(large, "h", "left_semi"), length))


def removed_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, step: int = STEP) -> DataFrame:
    """(key, spans): for rows of docs (key, text) that lose bytes, maximal runs as pairs of 32-bit ends."""
    return settled(docs.sparkSession, "ranges", lambda: _removed(docs, length, gram, crowd, step))


def _removed(docs: DataFrame, length: int, gram: int, crowd: int, step: int) -> DataFrame:
    found = store(contexts(docs, repeated_anchors(docs, length, gram), length, gram), "contexts")
    # boilerplate is one context with places in every task: its verdict, one row, goes to them
    joined = F.aggregate(F.collect_list("ranges"), F.lit(b""), lambda a, x: F.concat(a, x))
    told = all_verdicts(found, length, crowd, step).groupBy("ctx").agg(joined.alias("ranges"))
    told = store(told.join(found.groupBy("ctx").agg(F.count("*").alias("rows")), "ctx"), "told")
    hits = join_hot(found.select("ctx", "places"), told, "ctx", "rows", "inner")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, ends = [], [], []
            for places, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p, r = np.frombuffer(places, _PLACE), np.frombuffer(ranges, "<u2").reshape(-1, 2).astype(np.int64)
                at = p["at"].astype(np.int64)
                for a, b in r.tolist():
                    keys.append(p["doc"])
                    starts.append(at - b)
                    ends.append(at - a + length)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, starts, ends)], names=["key", "begin", "end"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for pairs in batch.column(1).to_pylist():
                out: list[list[int]] = []
                for a, b in sorted((x["begin"], x["end"]) for x in pairs):
                    if out and a <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], b)
                    else:
                        out.append([a, b])
                spans.append(np.array(out, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.binary())], names=["key", "spans"])

    wide = hits.select("places", "ranges").mapInArrow(expand, "key long, begin long, end long")
    # a document's ranges are as many as its anchors at most
    lists = wide.distinct().groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("pairs"))
    return lists.mapInArrow(merge, "key long, spans binary")


def with_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs with a last column of spans (null: nothing goes)."""
    key = unused("_key", docs.columns)
    spans = unused("_spans", docs.columns)
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    ranges = removed_ranges(keyed.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text")), length, gram)
    ranges = ranges.select(F.col("key").alias(key), F.col("spans").alias(spans))
    return keyed.join(F.broadcast(ranges) if bounded(ranges, RANGES) else ranges, key, "left").select(*[keyed[c] for c in docs.columns], spans)


def _kept(raw: memoryview, spans: bytes | None, words: int = 0) -> tuple[bytes, int]:
    """(what stays, number of removed runs); runs with fewer whole words than `words` stay."""
    if not spans:
        return bytes(raw), 0
    pairs = np.frombuffer(spans, "<u4").reshape(-1, 2).tolist()
    if words:
        pairs = [(a, b) for a, b in pairs if _whole_words(raw, a, b) >= words]
    cuts = [0, *[x for pair in pairs for x in pair], len(raw)]
    return b"".join([raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)]), len(pairs)


def _whole_words(raw: memoryview, begin: int, end: int) -> int:
    """Words that lie in raw[begin:end] from their first to their last byte."""
    inner = bytes(raw[begin:end])
    cut = begin > 0 and not kernels.SPACE[raw[begin - 1]] and not kernels.SPACE[inner[0]]
    torn = end < len(raw) and not kernels.SPACE[raw[end]] and not kernels.SPACE[inner[-1]]
    return max(0, len(inner.split()) - cut - torn)


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(1))
            view, out = memoryview(data), []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                kept, runs = _kept(view[offsets[i] : offsets[i + 1]], spans)
                size = int(offsets[i + 1] - offsets[i])
                out.append((size, size - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            made = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    spanned = with_spans(docs.select("doc_id", "text"), length, gram)
    return spanned.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: int = 0) -> DataFrame:
    """docs with what repeats cut from text; bytes of characters cut in two go as well.

    With `words`, a run of repeated bytes goes only if it holds so many whole words: a
    passage of so many words is found whatever its length in bytes, from `length` on.
    Null texts stay null; other columns stay as they are, but n_chars, where there is
    one, follows the text.
    """
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(at))
            view, spans = memoryview(data), batch.column(len(columns))
            texts = batch.column(at)
            if spans.null_count < len(spans):
                own = [_kept(view[offsets[i] : offsets[i + 1]], x, words)[0].decode("utf-8", "ignore") for i, x in enumerate(spans.to_pylist())]
                texts = pa.array(own, pa.string(), mask=np.asarray(texts.is_null()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 : -1]], names=columns)

    out = with_spans(docs, length, gram).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
