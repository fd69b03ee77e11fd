"""Packing tokenised documents into fixed-length sequences by bin completion.

Only the length of a piece matters for where it fits, so the search runs over a table
of how many pieces have each length: at most `capacity` rows at any corpus size. The
branch and bound takes the largest remaining length, enumerates the undominated ways to
complete its sequence, applies each to as many sequences as the counts allow, and prunes
by the waste the incumbent leaves; incumbents come from best fit. What it returns is a
list of patterns with multiplicities, from which each piece finds its sequence by its
rank among the pieces of its length.

Completions are enumerated as they are asked for, a few at a time with the least waste
first, and only NODES bounds the search: each place that is tried in a sequence is one.
When best fit meets the lower bound, which it does where small pieces abound, no node is
spent. `search` tells what was found, the bound and the nodes spent; a packing above the
bound is the best there is only if the search ended before its nodes were spent.

Null or empty text is the end marker alone (one token). Very long texts are tokenised
whole and cut into pieces. Repeated rows are packed once per row. Columns of documents
that are named like those of pieces give way to them. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import slices, store
from .ranks import rank_within

#: Nodes of the search before the incumbent is returned.
NODES = 400_000
#: Completions that are looked at together, to try those with least waste first.
AHEAD = 16
#: Steps between two best-fit runs over what is left, which renew the incumbent.
RENEW = 128


# ---------------------------------------------------------------- search


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: the better of the sum bound and the bound by large pieces."""
    n = np.zeros(capacity + 1, np.int64)
    for size, number in counts.items():
        n[size] = number
    pieces_, tokens = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * np.arange(capacity + 1)))
    best = -(-int(tokens[-1]) // capacity)
    half = capacity // 2
    for k in range(half + 1):
        big = int(pieces_[-1] - pieces_[capacity - k + 1])  # more than capacity - k: alone but for pieces below k
        mid = int(pieces_[capacity - k + 1] - pieces_[half + 1])
        room = mid * capacity - int(tokens[capacity - k + 1] - tokens[half + 1])
        low = int(tokens[half + 1] - tokens[k])
        best = max(best, big + mid + max(0, -(-(low - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a length table: patterns (lengths, longest first) and their numbers."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], bins: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, bins))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else None
            pattern, bins = open_[room].pop() if room is not None else ((), left)
            if room is not None and not open_[room]:
                del open_[room], rooms[at]
            room = capacity if room is None else room
            fit = room // size
            full = min(bins, left // fit)
            if full:
                put(room - fit * size, pattern + (size,) * fit, full)
                left -= full * fit
                bins -= full
            if left and bins and left < fit:
                put(room - left * size, pattern + (size,) * left, 1)
                left, bins = 0, bins - 1
            if bins and pattern:
                put(room, pattern, bins)
    found: Counter = Counter()
    for groups in open_.values():
        for pattern, bins in groups:
            found[pattern] += bins
    return sorted(found.items(), reverse=True)


class Nodes:
    """How many nodes a search may still spend."""

    def __init__(self, most: int):
        self.most = self.left = most

    def spend(self) -> bool:
        self.left -= 1
        return self.left >= 0

    @property
    def spent(self) -> int:
        return self.most - max(0, self.left)


def fillings(sizes: list[int], counts: dict[int, int], room: int, most: int, nodes: Nodes, first: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], int]]:
    """(pieces, waste) of the undominated fillings of `room` that waste `most` at most, beside the pieces of first; longest pieces first.

    sizes are in ascending order, counts how many there are of each. A filling is
    dominated when a further piece fits, or one of its pieces can give way to a longer
    unused one: the other filling wastes less and leaves smaller pieces. What is left to
    enumerate is read as it stands when it is asked for, so sizes and counts must be what
    they were.
    """

    def unused(s: int, taken: tuple[int, ...]) -> bool:
        return counts[s] > taken.count(s)

    def dominated(taken: tuple[int, ...], left: int) -> bool:
        if not left:
            return False
        if any(unused(s, taken) for s in sizes[: bisect_right(sizes, left)]):
            return True
        return any(unused(s, taken) for t in set(taken[len(first) :]) for s in sizes[bisect_right(sizes, t) : bisect_right(sizes, t + left)])

    def add(below: int, left: int, taken: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        """Goes down by lengths, not by pieces: no more of them than different lengths fit."""
        if not nodes.spend():
            return
        fits = False
        for i in range(min(below, bisect_right(sizes, left)) - 1, -1, -1):
            s = sizes[i]
            for k in range(min(counts[s] - first.count(s), left // s), 0, -1):
                fits = True
                yield from add(i, left - k * s, taken + (s,) * k)
                if nodes.left < 0:
                    return
        if not fits and left <= most and not dominated(taken, left):
            yield taken[len(first) :], left

    yield from add(len(sizes), room, first)


def completions(sizes: list[int], counts: dict[int, int], room: int, most: int, nodes: Nodes, first: tuple[int, ...] = ()) -> Iterator[tuple[int, ...]]:
    """The fillings as they come, of each AHEAD of them those with least waste first."""
    every = fillings(sizes, counts, room, most, nodes, first)
    while some := list(itertools.islice(every, AHEAD)):
        yield from (taken for taken, _ in sorted(some, key=lambda x: (x[1], [-s for s in x[0]])))


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their numbers, with as few sequences as the search finds."""
    return search(counts, capacity, nodes)[0]


def search(counts: dict[int, int], capacity: int, nodes: int = NODES) -> tuple[list[tuple[tuple[int, ...], int]], int, int]:
    """(patterns and their numbers, lower bound of sequences, nodes spent).

    The fewest possible when the bound is met. Each step fills as many sequences with one
    pattern as the counts allow, so it uses up a length and a descent has no more steps
    than there are lengths; fewer at a time is the other branch.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    if not counts:
        return [], 0, 0
    bound, best = lower_bound(counts, capacity), best_fit(counts, capacity)
    least = sum(n for _, n in best)
    total = sum(s * n for s, n in counts.items())
    left, sizes = dict(counts), sorted(counts)
    done: list[tuple[tuple[int, ...], int]] = []
    used = wasted = steps = 0
    budget = Nodes(nodes)

    def branches() -> Iterator[tuple[tuple[int, ...], int]]:
        top = sizes[-1]
        allowed = (least - 1) * capacity - total - wasted
        for filling in completions(sizes, left, capacity - top, allowed, budget, (top,)):
            pattern = (top, *filling)
            times = min(left[s] // k for s, k in Counter(pattern).items())
            for k in dict.fromkeys((times, 1)):
                yield pattern, k

    def take(pattern: tuple[int, ...], k: int) -> None:
        for s in pattern:
            left[s] -= k
            if not left[s]:
                del left[s]
                del sizes[bisect_left(sizes, s)]

    def give(pattern: tuple[int, ...], k: int) -> None:
        for s in pattern:
            if s not in left:
                left[s] = 0
                insort(sizes, s)
            left[s] += k

    stack = [branches()] if least > bound else []
    while stack and budget.left > 0 and least > bound:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if done:
                pattern, k = done.pop()
                give(pattern, k)
                used -= k
                wasted -= k * (capacity - sum(pattern))
            continue
        pattern, k = step
        steps += 1
        budget.spend()
        waste = wasted + k * (capacity - sum(pattern))
        if waste > (least - 1) * capacity - total:  # the incumbent is no worse
            continue
        take(pattern, k)
        done.append(step)
        used, wasted = used + k, waste
        if not left or steps % RENEW == 0:
            rest = best_fit(left, capacity)
            if used + sum(n for _, n in rest) < least:
                best, least = done + rest, used + sum(n for _, n in rest)
        stack.append(branches() if left else iter(()))
    merged: Counter = Counter()
    for pattern, n in best:
        merged[pattern] += n
    return sorted(merged.items(), reverse=True), bound, budget.spent


# ---------------------------------------------------------------- tokens


class ByteLevel:
    """Ids of a byte-level BPE vocabulary file of the tokenizers library, special strings included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        back = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if token not in special}
        in_order = all(vocab["".join(m if isinstance(m, list) else m.split(" "))] == len(ranks) - len(merges) + i for i, m in enumerate(merges))
        if in_order:
            import tiktoken
            from public_tokenizers import PATTERN

            fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.ids = lambda text: np.array(fast.encode(text, allowed_special="all"), dtype="<u4")
        else:  # ids that don't follow the merge order: only the library itself can say
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            slow.no_truncation()
            slow.no_padding()
            self.ids = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=4)
def load(path: str) -> ByteLevel:
    return ByteLevel(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: the columns of docs but text, then piece, start, length, ids_crc32 (and ids).

    Documents longer than capacity are cut into pieces of that length, the first of
    which may be shorter.
    """
    new = ["piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    kept = [c for c in docs.columns if c != "text" and c not in new]
    source = docs.select(*[docs[c] for c in kept], docs["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(vocabulary)
        end = np.array([end_id], "<u4")
        for batch in slices(batches, "text"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(len(kept)).to_pylist()):
                all_ids = np.concatenate([tokens.ids(text), end]) if text else end
                cuts = [*range(len(all_ids), 0, -capacity), 0][::-1]
                for k in range(len(cuts) - 1):
                    part = all_ids[cuts[k] : cuts[k + 1]].tobytes()
                    row.append(i)
                    piece.append(k)
                    start.append(cuts[k])
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            take = pa.array(row, pa.int32())
            made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *([pa.array(ids, pa.binary())] if keep_ids else [])]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(take) for i in range(len(kept))], *made], names=[*kept, *new])

    types = ["int", "long", "long", "long", "binary"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*kept).schema] + [f"{n} {t}" for n, t in zip(new, types, strict=False)])
    return source.mapInArrow(run, schema)


def pack(parts: DataFrame, capacity: int = 2048, identity: tuple[str, ...] = ("doc_id", "piece"), nodes: int = NODES) -> DataFrame:
    """parts (with a column length of 1 to capacity) with sequence_id and offset.

    parts must be stored: it is read twice, and its rows are told apart by their places in
    its files. Rows of equal identity and length are interchangeable; each gets its own place.
    """
    table = {int(s): int(n) for s, n in parts.groupBy("length").count().collect()}  # at most capacity rows
    if table and not 1 <= min(table) <= max(table) <= capacity:
        raise ValueError("lengths must be from 1 to the capacity")
    found = bin_completion(table, capacity, nodes)
    taken: Counter = Counter()
    steps, first = [], 0
    for pattern, number in found:
        at = 0
        for size, times in sorted(Counter(pattern).items(), reverse=True):
            steps.append((size, taken[size], times, first, at))
            taken[size] += times * number
            at += size * times
        first += number
    steps.sort()
    plan = np.array(steps, dtype=np.int64).reshape(-1, 5)
    keys = plan[:, 0] << 48 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.schema.get_field_index("_rank")))
            step = plan[np.searchsorted(keys, size << 48 | rank, side="right") - 1]
            nth = rank - step[:, 1]
            sequence = step[:, 3] + nth // np.maximum(step[:, 2], 1)
            offset = step[:, 4] + nth % np.maximum(step[:, 2], 1) * size
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sequence), pa.array(offset)], names=[*[n for n in batch.schema.names if n != "_rank"], "sequence_id", "offset"])

    rows = parts.drop("sequence_id", "offset")
    order = [F.col(c) for c in identity]
    # A third of all rows may share a length; one bucket per 20,000 rows keeps its tasks small.
    buckets = max(8, sum(table.values()) // 20_000)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # the same each time: parts is stored
    ranked = rank_within(rows, "length", [*order, F.col("_row")], F.struct(*order, F.col("_row")), buckets, "_rank").drop("_row")
    rows = rows.drop("_row")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], "sequence_id long", "offset long"])
    return ranked.select(*rows.columns, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Tokenises, cuts and packs docs (doc_id, text); one row per piece."""
    return pack(store(pieces(docs.select("doc_id", "text"), vocabulary, capacity, end_id), "pieces"), capacity)
