"""Near-duplicate classes by exact Jaccard similarity of word shingles: a prefix-tree join.

A document is the set of its distinct `width`-word shingles, as 64-bit keys whose order
is the global order: a class of frequency (0: not known to be frequent), then a hash.
Rare shingles come first. Two sets that are similar enough share a known number of keys
among the first few of each; a shuffle of those few keys counts what pairs share, or,
under keys that many sets have, chains sets of similar size. A key known to be frequent
(HOT) is never counted: a set whose other keys are too many for it to be similar to
anything through frequent ones alone does not go there at all, and the rest go under
the rarest of them only, as many as any similar set must share one of. That links documents into
coarse groups that are sure to hold every similar pair. Within a small coarse group the sets stand in a trie; each set
walks it once, overlaps are carried along shared paths, and a subtree is left as soon as
the lengths that remain can't reach the threshold, or all its sets are linked already.
In a larger one each set is compared with those that no set of its class has reached yet,
if they share one of their first keys in the group's own order: a class of near copies is
passed over once most of it is reached, and sets that are like none cost next to nothing.

Equal sets are one node, joined back at the end, so copies are never paired. A node is a
63-bit signature of the set; a second one of 64 bits tells whether two different sets
share it, and then both take part in the signature, so no two sets are taken for one.
Shingles are compared by 56 bits of hash. A coarse group larger than `block` shingles is split: first its parts are
joined with a few leaders of the group, then what did not fall to the group's largest
class is joined with every part (the square of what is left, over `block`, in the worst
case). Nothing is dropped, capped or sampled.

Frequencies only set the order, which changes cost and never results: they come from
every document, as sums of counts that tasks see twice or more; the table that goes
to the tasks holds FREQUENT keys at most.

Null, empty and wordless texts have an empty set and link with nothing. A text of fewer
words than the width is one shingle. Very long texts are sets like others, whole. Rows
without doc_id belong to their class but don't name it; a class without any doc_id has a
null component_id. Repeated rows are kept, one result a row. Other columns, whatever
their names, play no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import bounded, bytes_of, has_rows, join_hot, release, settled, slices, store, trim
from .components import connected_components

WIDTH = 5
#: Keys in the broadcast frequency table at most (9 bytes each).
FREQUENT = 1 << 20
#: Shingles a task gathers before it counts them, and those it gathers before it sorts and hands on.
COUNTED, WINDOW = 2_000_000, 500_000
#: Bytes of texts that are cut into shingles together.
TOGETHER = 1 << 19
#: Shingles of a block in the join of a coarse group.
BLOCK = 2_000_000
#: Sets up to which a block goes through a trie; each set's walk there may touch all others.
FEW = 64
#: Words of 64 bits for the most frequent keys of a larger block's sets.
WORDS = 16
#: Rows of a broadcast semi-join side at most (8 bytes each).
KEYS = 2_000_000
LEADERS = 8
#: Nodes under a key up to which their pairs are counted; larger keys are chained.
GROUP = 64
#: Class of frequency (four times the binary logarithm of the count) from which a key is chained at once.
HOT = 32
#: Percent of a set's keys dealt out beyond those of which one must be shared.
SHARE = 5


# ---------------------------------------------------------------- sets


def shingle_sets(column: pa.Array, width: int, frequent: kernels.HashArrays | None) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): each text's set in global order."""
    data, offsets = kernels.flat(column)
    data = kernels.LOWER[data]
    starts, ends, first = kernels.words(data, offsets)
    hashes = kernels.range_hashes(data, starts, ends)
    shingles, at = kernels.windows(hashes, first, width)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = n[short] > k
            extra[has] = kernels.mix(extra[has] * kernels._BASE + hashes[first[short[has]] + k] + np.uint64(k + 1))
        where = np.searchsorted(at, first[short])
        shingles = np.insert(shingles, where, extra)
    lengths = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    keys = shingles >> np.uint64(8)
    if frequent is not None:
        keys |= frequent.get(keys).astype(np.uint64) << np.uint64(56)
    first = np.append(0, np.cumsum(lengths))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a > 1:
            keys[a:b].sort()
    new = np.ones(len(keys), bool)
    if len(keys):
        new[1:] = keys[1:] != keys[:-1]
        new[first[:-1][lengths > 0]] = True
    return keys[new], np.append(0, np.cumsum(new))[first]


def signatures(keys: np.ndarray, first: np.ndarray, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(node, mark): two independent signatures of each set; the hash part of the keys alone decides.

    shared: nodes that different sets have; a set's mark then decides its node too.
    """
    bare, n = keys & np.uint64((1 << 56) - 1), np.diff(first).astype(np.uint64)
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        sums = np.zeros(len(keys) + 1, np.uint64)
        np.cumsum(kernels.mix(kernels.mix(bare + np.uint64(salt)) + np.uint64(salt)), out=sums[1:])
        out.append(kernels.mix((sums[first[1:]] - sums[first[:-1]]) ^ kernels.mix(n + np.uint64(salt))))
    node = (out[0] >> np.uint64(1)).astype(np.int64)
    if shared is not None and len(shared):
        both = np.isin(node, shared)
        node[both] = (kernels.mix(out[0][both] ^ kernels.mix(out[1][both])) >> np.uint64(1)).astype(np.int64)
    return node, out[1].view(np.int64)


def _runs(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def frequencies(docs: DataFrame, width: int, most: int = FREQUENT) -> tuple[kernels.HashArrays, int]:
    """(class by key of the most frequent shingles, number of shingles in all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0

        def repeated() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            at = _runs(keys)
            n = np.diff(np.append(at, len(keys)))
            twice = n > 1
            return _pairs(keys[at[twice]].astype(np.int64), n[twice])

        def _pairs(keys, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

        for batch in slices(batches, "text", TOGETHER):
            keys, _ = shingle_sets(batch.column(0), width, None)
            held.append(keys)
            size += len(keys)
            total += len(keys)
            if size >= COUNTED:
                yield repeated()
                held, size = [], 0
        if held:
            yield repeated()
        yield _pairs([-1], [total])

    counts = store(docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n >= 4 or key < 0"), "frequent")
    total = counts.where("key < 0").agg(F.sum("n")).first()[0] or 0
    step = F.least(F.lit(255), (4 * F.log2("n")).cast("int")).alias("step")
    sizes = {r[0]: r[1] for r in counts.where("key >= 0").groupBy(step).count().collect()}  # 255 rows at most
    room, least = most, 256
    for k in sorted(sizes, reverse=True):
        room -= sizes[k]
        if room < 0:
            break
        least = k
    got = counts.where("key >= 0").select("key", step).where(F.col("step") >= least).toArrow()
    return kernels.HashArrays(got.column("key").to_numpy().astype(np.uint64), got.column("step").to_numpy().astype(np.uint8), 0), int(total)


# ---------------------------------------------------------------- coarse groups


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first keys are dealt out.

    A few more than any similar set must share one of: then it must share SHARE percent
    of the larger set's keys, which a common passage in long texts does not reach.
    """
    return np.minimum(size, (100 - percent + SHARE) * size // 100 + 1)


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Keys that two similar sets of these sizes have in common among those dealt out, at least.

    One of the two runs out first; all that they share but what follows there lies among both's first keys.
    """
    larger = np.maximum(a, b)
    overlap = -(-percent * (a + b) // (100 + percent))
    return np.maximum(1, overlap - (larger - prefix_length(larger, percent)))


def least_needed(size: np.ndarray, percent: int) -> np.ndarray:
    """`needed` of a set of this size and any similar one, at least (it is least at either end of their sizes)."""
    ends = [needed(size, other, percent) for other in (-(-percent * size // 100), 100 * size // percent)]
    return np.maximum(1, np.minimum(*ends) - 1)


def chain(keys: np.ndarray, sizes: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """For entries in order of key and size, whether each begins a chain.

    Within a key a chain goes on while sizes stay within reach of one before; every
    pair of sizes similar enough is in one chain.
    """
    at = _runs(keys)
    lift = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys)))) << 32
    far = np.maximum.accumulate(reach + lift)
    begins = np.ones(len(keys), bool)
    begins[1:] = (keys[1:] != keys[:-1]) | (sizes[1:] + lift[1:] > far[:-1])
    return begins


_MIXED = "kind int, doc_id long, text_key long, n long, node long, mark long, text_mark long, bucket int, body binary"
_NAMES = [c.split(" ")[0] for c in _MIXED.split(", ")]
_KINDS = [pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.binary()]
_MEMBER, _ENTRIES, _EDGE, _CHAINS = range(4)
#: hot: keys of the set among those dealt out that are chained at once.
_ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("size", "<i4"), ("hot", "<i4")])
_CHAIN = np.dtype([("key", "<u8"), ("node", "<i8"), ("size", "<i4"), ("reach", "<i4")])


def _mixed(rows: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)


def _edges(a: np.ndarray, b: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    """Edge rows, equal ones added up: n and node are the ends, doc_id how often, text_key how often is enough."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b, need = a[order], b[order], need[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(a)))
    least = np.minimum.reduceat(need, new) if len(a) else need
    return _mixed(len(new), kind=np.full(len(new), _EDGE, np.int32), n=a[new], node=b[new], doc_id=times, text_key=least)


def _pairs(entries: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs within each key of at most GROUP entries whose sizes can be similar, with how many keys they need."""
    at = _runs(entries["key"])
    many = np.diff(np.append(at, len(entries)))
    out = []
    for g in np.unique(many[many > 1]).tolist():
        rows = at[many == g][:, None] + np.arange(g)
        i, j = np.triu_indices(g, 1)
        for block in np.array_split(rows, max(1, len(rows) * len(i) // 2_000_000)):
            x, y = entries[block[:, i].ravel()], entries[block[:, j].ravel()]
            p, q = x["size"].astype(np.int64), y["size"].astype(np.int64)
            ok = 100 * np.minimum(p, q) >= percent * np.maximum(p, q)
            least = needed(p[ok], q[ok], percent) - np.minimum(x["hot"][ok], y["hot"][ok])
            out.append((x["node"][ok], y["node"][ok], np.maximum(1, least)))
    return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))


def _linked(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): neighbours in the chains of a table of chain entries, in order of key and size; and which begin one."""
    begins = chain(table["key"], table["size"].astype(np.int64), table["reach"].astype(np.int64))
    on = np.flatnonzero(~begins)
    return on, begins


def sketch(docs: DataFrame, width: int, percent: int, frequent: kernels.HashArrays, total: int, several: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(members, edges): one row (doc_id, text_key, text_mark, n, node, mark) per document, and coarse edges (a, b).

    Two nodes have an edge if they share enough of their first keys in keys of at most
    GROUP nodes, or follow one another in a chain of a larger key. What a pair needs to
    share in counted keys is less by the hot ones it may share; a pair that may need none
    shares enough hot ones to meet in a chain.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + total // 5_000_000)
    shared = spark.sparkContext.broadcast(frequent)

    def chained(entries: np.ndarray) -> np.ndarray:
        table = np.zeros(len(entries), _CHAIN)
        for name in ("key", "node", "size"):
            table[name] = entries[name]
        table["reach"] = 100 * entries["size"].astype(np.int64) // percent
        return table

    def large_keys(entries: np.ndarray) -> np.ndarray:
        at = _runs(entries["key"])
        many = np.diff(np.append(at, len(entries)))
        return np.repeat(many > GROUP, many)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, TaskContext.get().partitionId() * 7919  # members go round the buckets, each task from another one

        def bodies(kind: int, table: np.ndarray) -> pa.RecordBatch:
            bucket = (kernels.mix(table["key"].copy()) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            table, bucket = table[order], bucket[order]
            at = _runs(bucket)
            cut = [table[a:b].tobytes() for a, b in zip(at, np.append(at[1:], len(bucket))[: len(at)], strict=True)]
            return _mixed(len(at), kind=np.full(len(at), kind, np.int32), bucket=bucket[at], body=cut)

        def dealt() -> Iterator[pa.RecordBatch]:
            entries = _distinct(np.concatenate(held))
            large = large_keys(entries) | (entries["key"] >> np.uint64(56) >= HOT)
            yield bodies(_ENTRIES, entries[~large])
            if large.any():
                # a chain within the task is linked here and goes on as its smallest set with its widest reach
                table = chained(entries[large])
                on, begins = _linked(table)
                yield _edges(table["node"][on - 1], table["node"][on], np.zeros(len(on), np.int64))
                first = np.flatnonzero(begins)
                out = table[first]
                out["reach"] = np.maximum.reduceat(table["reach"], first)
                yield bodies(_CHAINS, out)

        for batch in slices(batches, "text", TOGETHER):
            keys, first = shingle_sets(batch.column(0), width, shared.value)
            n = np.diff(first)
            node, mark = signatures(keys, first, several)
            rows = len(batch)
            yield _mixed(rows, kind=np.zeros(rows, np.int32), doc_id=batch.column(1), text_key=batch.column(2), n=n, node=pa.array(node, mask=n == 0), mark=mark, text_mark=batch.column(3), bucket=((turn + np.arange(rows)) % parts).astype(np.int32))
            turn += rows
            at, dealt_out = np.arange(len(keys)) - np.repeat(first[:-1], n), prefix_length(n, percent)
            use = at < np.repeat(dealt_out, n)
            frequent_ = use & (keys >> np.uint64(56) >= HOT)
            hot = kernels.totals(frequent_, first)
            # frequent keys are a set's last: of those only the first few that any similar set must share one of
            few = np.where(hot >= (least := least_needed(n, percent)), dealt_out - least + 1, 0)
            use &= ~frequent_ | (at < np.repeat(few, n))
            made = np.zeros(int(use.sum()), _ENTRY)
            made["key"], made["node"], made["size"], made["hot"] = keys[use], np.repeat(node, n)[use], np.repeat(n, n)[use], np.repeat(hot, n)[use]
            held.append(made)
            size += len(made)
            if size >= WINDOW:
                yield from dealt()
                held, size = [], 0
                trim()
        if held:
            yield from dealt()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {_ENTRIES: [np.zeros(0, _ENTRY)], _CHAINS: [np.zeros(0, _CHAIN)]}
        for batch in batches:
            kind = np.asarray(batch.column(0))
            rest = (kind != _ENTRIES) & (kind != _CHAINS)
            if rest.any():
                yield batch.filter(pa.array(rest))
            for k, dtype in ((_ENTRIES, _ENTRY), (_CHAINS, _CHAIN)):
                held[k] += [np.frombuffer(b, dtype) for b in batch.filter(pa.array(kind == k)).column(8).to_pylist()]
        entries, chains = _distinct(np.concatenate(held[_ENTRIES])), np.concatenate(held[_CHAINS])
        large = large_keys(entries) | np.isin(entries["key"], chains["key"])
        yield _edges(*_pairs(entries[~large], percent))
        table = np.concatenate([chained(entries[large]), chains])
        table = table[np.lexsort((table["size"], table["key"]))]
        on, _ = _linked(table)
        yield _edges(table["node"][on - 1], table["node"][on], np.zeros(len(on), np.int64))

    mixed = docs.select("text", "doc_id", "text_key", "text_mark").mapInArrow(deal, _MIXED).repartition(parts, "bucket").mapInArrow(meet, _MIXED).drop("bucket", "body")
    done = store(mixed, "sketch")
    release(spark)
    edges = done.where(f"kind = {_EDGE}").groupBy(F.col("n").alias("a"), F.col("node").alias("b")).agg(F.sum("doc_id").alias("times"), F.min("text_key").alias("need"))
    return done.where(f"kind = {_MEMBER}").select("doc_id", "text_key", "text_mark", "n", "node", "mark"), edges.where("times >= need").select("a", "b")


def _distinct(entries: np.ndarray) -> np.ndarray:
    """entries in order of key, size and node, equal ones once."""
    entries = entries[np.lexsort((entries["node"], entries["size"], entries["key"]))]
    same = (entries["key"][1:] == entries["key"][:-1]) & (entries["node"][1:] == entries["node"][:-1])
    return entries[np.append(True, ~same)] if len(entries) else entries


# ---------------------------------------------------------------- the trie


class Trie:
    """Sets (ascending uint64 arrays) under shared prefixes; single-set tails stay arrays."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        # a node: [run begin, run end, set whose run it is, children, shortest, longest, uniform]
        self.root = self._node(order, 0)

    def _node(self, order: list[int], depth: int) -> list:
        todo_root: list = [depth, depth, order[0] if order else -1, [], 0, 0, False]
        stack = [(order, depth, todo_root)]
        made = []
        while stack:
            group, begin, node = stack.pop()
            a, b = self.sets[group[0]], self.sets[group[-1]]
            end = min(len(a), len(b))
            differ = np.flatnonzero(a[begin:end] != b[begin:end])
            end = begin + int(differ[0]) if len(differ) else end
            lengths = [len(self.sets[i]) for i in group]
            node[0], node[1], node[2], node[4], node[5] = begin, end, group[0], min(lengths), max(lengths)
            made.append(node)
            if len(group) == 1:
                node[6] = True
                continue
            i = 0
            while i < len(group):
                own = self.sets[group[i]]
                j = i + 1
                if len(own) == end:  # ends here: a leaf of its own
                    node[3].append([end, end, group[i], [], end, end, True])
                else:
                    while j < len(group) and self.sets[group[j]][end] == own[end]:
                        j += 1
                    child: list = [0, 0, 0, [], 0, 0, False]
                    node[3].append(child)
                    stack.append((group[i:j], end, child))
                i = j
        return todo_root

    def join(self, x: int, percent: int, find, link) -> None:
        """Links set x with each similar set that isn't in its class yet."""
        xs = self.sets[x]
        n = len(xs)
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            begin, end, rep, children, shortest, longest, uniform = node
            if uniform and find(rep) == find(x):
                continue
            if 100 * shortest * percent > 10_000 * n or 100 * longest < percent * n:
                continue
            need = -(-percent * (n + shortest) // (100 + percent))
            done = True
            while begin < end:
                stop = min(end, begin + 64) if begin == node[0] else end
                run = self.sets[rep][begin:stop]
                at = np.searchsorted(xs, run)
                hit = at < n
                overlap += int((xs[at[hit]] == run[hit]).sum())
                passed = int(at[-1]) + int(at[-1] < n and xs[at[-1]] == run[-1])
                begin = stop
                if overlap + min(n - passed, longest - stop) < need:
                    done = False
                    break
            if not done:
                continue
            if not children:
                size = len(self.sets[rep])
                if rep != x and (100 + percent) * overlap >= percent * (n + size):
                    link(x, rep)
                continue
            if not uniform and all(c[6] for c in children):
                same = find(children[0][2])
                if all(find(c[2]) == same for c in children[1:]):
                    node[6] = True
                    if same == find(x):
                        continue
            stack.extend((c, overlap) for c in children)


class Lists:
    """Sets in order of size, with lists of which sets have a key among their first ones.

    Keys are ranked by how many of these sets have them, rare ones first; two similar sets
    share one of the first few of each. The most frequent keys are bits of a row for each
    set, so what two sets share of them is counted a word at a time; of the others a set
    holds those that another one has too.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        sizes = np.array([len(x) for x in sets])
        self.order = np.argsort(sizes, kind="stable")  # place -> index of the set
        self.n = sizes[self.order]
        first = np.append(0, np.cumsum(self.n))
        _, key, times = np.unique(np.concatenate([sets[i] for i in self.order.tolist()]), return_inverse=True, return_counts=True)
        rank = np.empty(len(times), np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(len(times))
        times, key = np.sort(times), rank[key]
        place = np.repeat(np.arange(len(sets)), self.n)
        key += place * len(times)
        key.sort()  # within each set by rank
        key -= place * len(times)
        self.alive = np.ones(len(sets), bool)
        shared, hot = times[key] > 1, key >= len(times) - 64 * WORDS
        few = self.n - -(-percent * self.n // 100) + 1
        head = shared & (np.arange(len(key)) - np.repeat(first[:-1], self.n) < np.repeat(few, self.n))
        self.heads, self.heads_at = key[head], np.append(0, np.cumsum(head))[first]
        by_key = np.argsort(self.heads, kind="stable")
        self.listed = place[head][by_key].astype(np.int32)
        self.begins = np.searchsorted(self.heads[by_key], np.arange(len(times) + 1)).astype(np.int32)
        cold = shared & ~hot
        self.cold, self.cold_at = key[cold].astype(np.int32), np.append(0, np.cumsum(cold))[first]
        bit = key[hot] - (len(times) - 64 * WORDS)
        self.bits = np.zeros((len(sets), WORDS), np.uint64)
        np.bitwise_or.at(self.bits, (place[hot], bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        self.flags = np.zeros(len(times), bool)

    def similar(self, x: int) -> np.ndarray:
        """Places of the sets still alive that are similar to that at place x."""
        n, percent = int(self.n[x]), self.percent
        heads = self.heads[self.heads_at[x] : self.heads_at[x + 1]]
        begin, end = self.begins[heads], self.begins[heads + 1]
        low, high = np.searchsorted(self.n, -(-percent * n // 100)), np.searchsorted(self.n, 100 * n // percent, side="right")
        if int((end - begin).sum()) < high - low:
            met = np.zeros(high - low, bool)
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                own = self.listed[a:b]
                met[own[(own >= low) & (own < high)] - low] = True
            met &= self.alive[low:high]
        elif len(heads):
            met = self.alive[low:high]
        else:
            return np.zeros(0, np.int64)
        found = low + np.flatnonzero(met)
        if not len(found):
            return found
        overlap = np.bitwise_count(self.bits[found] & self.bits[x]).sum(axis=1, dtype=np.int64)
        own = self.cold[self.cold_at[x] : self.cold_at[x + 1]]
        if len(own):
            self.flags[own] = True
            many = self.cold_at[found + 1] - self.cold_at[found]
            at = np.repeat(self.cold_at[found] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            overlap += kernels.totals(self.flags[self.cold[at]], np.append(0, np.cumsum(many)))
            self.flags[own] = False
        return found[(100 + percent) * overlap >= percent * (n + self.n[found])]

    def join(self, find, link) -> None:
        """Links the sets of a class by searching, for each set reached, those that none has reached yet."""
        order = self.order.tolist()
        own = [find(i) for i in order]
        members: dict[int, list[int]] = {}
        for place, k in enumerate(own):
            members.setdefault(k, []).append(place)
        for seed in range(len(order)):
            todo = members.pop(own[seed], [])
            self.alive[todo] = False
            while todo:
                x = todo.pop()
                for y in self.similar(x).tolist():
                    link(order[x], order[y])
                    more = members.pop(own[y], [])
                    self.alive[more] = False
                    todo += more


def classes(sets: list[np.ndarray], percent: int, known: list[int] | None = None) -> list[int]:
    """For each set the index of its class's first set; known: classes that hold already."""
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(i: int, j: int) -> None:
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)

    if known:
        seen: dict[int, int] = {}
        for i, k in enumerate(known):
            link(i, seen.setdefault(k, i))
    if len(sets) > FEW:
        Lists(sets, percent).join(find, link)
    elif len(sets) > 1:
        trie = Trie(sets)
        for i in range(len(sets)):
            trie.join(i, percent, find, link)
    return [find(i) for i in range(len(sets))]


def _join_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) from each node of rows (block string, node, known, body) to the first of its class in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        out_a, out_b = [], []

        def close() -> None:
            nodes = sorted(held)
            found = classes([held[k][1] for k in nodes], percent, [held[k][0] for k in nodes])
            for i, j in enumerate(found):
                out_a.append(nodes[i])
                out_b.append(nodes[j])

        def rows_() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
            out_a.clear()
            out_b.clear()
            return made

        for batch in batches:
            raw, starts, ends = bytes_of(batch.column(3))
            for i, (block, node, known) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)):
                if block != now:
                    if held:
                        close()
                    now, held = block, {}
                if node not in held:
                    held[node] = (known, np.frombuffer(raw[starts[i] : ends[i]].tobytes(), "<u8"))
            yield rows_()
        if held:
            close()
        yield rows_()
        trim()

    dealt = rows.select("block", "node", "known", "body").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "a long, b long")


def similar_nodes(docs: DataFrame, members: DataFrame, nodes: DataFrame, edges: DataFrame, width: int, percent: int, frequent: kernels.HashArrays, several: np.ndarray, block: int = BLOCK) -> DataFrame:
    """(node, label) of nodes in coarse groups, label one node of the class.

    nodes (node, text_key, n) has a row for each set, however many members hold it.
    """
    spark = docs.sparkSession
    coarse = store(connected_components(edges).withColumnRenamed("component", "comp"), "coarse")
    wanted = store(nodes.select("node", "text_key", "n").join(coarse, "node"), "wanted")
    weights = wanted.groupBy("comp").agg(F.sum("n").alias("weight"), F.count("*").alias("of"))
    wanted = store(join_hot(wanted, weights, "comp", "of", "inner"), "wanted")
    release(spark)
    few = bounded(wanted, KEYS)
    shared = spark.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", TOGETHER):
            keys_, first = shingle_sets(batch.column(0), width, shared.value)
            nodes, out, bodies = signatures(keys_, first, several)[0].tolist(), [], []
            for i, node in enumerate(nodes):
                if node not in seen and first[i + 1] > first[i]:
                    if len(seen) < 500_000:
                        seen.add(node)
                    out.append(node)
                    bodies.append(keys_[first[i] : first[i + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(bodies, pa.binary())], names=["node", "body"])

    def bodies(which: str) -> DataFrame:
        """(node, comp, n, weight, body); only small tables move while they are few."""
        chosen = wanted.where(which)
        keys, own = chosen.select("text_key").distinct(), chosen.drop("text_key", "of")
        if few:
            texts = docs.join(F.broadcast(keys), "text_key", "left_semi")
        else:  # a third of all rows may share a text
            times = members.groupBy("text_key").agg(F.count("*").alias("rows"))
            texts = join_hot(docs, store(times.join(keys, "text_key", "left_semi"), "times"), "text_key", "rows", "inner")
        found = texts.select("text").mapInArrow(run, "node long, body binary")
        return found.join(F.broadcast(own) if few else own, "node")

    none = F.col("node").alias("known")
    small = bodies(f"weight <= {block}").select(F.col("comp").cast("string").alias("block"), "node", none, "body")
    found = _join_blocks(small, percent).select(F.col("a").alias("node"), F.col("b").alias("label"))
    if not has_rows(wanted.where(f"weight > {block}")):
        return found
    found = store(found, "labels")

    large = bodies(f"weight > {block}").withColumn("parts", F.ceil(F.col("weight") / block).cast("int")).dropDuplicates(["node"])
    large = store(large.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), "large")
    release(spark)
    # round one: every part with the leaders of its group
    leaders = large.groupBy("comp", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(LEADERS))).agg(F.min("node").alias("node"))
    lead = large.join(leaders.select("comp", "node"), ["comp", "node"], "left_semi").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    name = lambda *c: F.concat_ws(":", *[F.col(x).cast("string") for x in c]).alias("block")
    first = store(_join_blocks(large.unionByName(lead.select(large.columns)).select(name("comp", "part"), "node", none, "body"), percent), "first")
    known = connected_components(first).withColumnRenamed("component", "known")
    large = store(large.join(known, "node", "left").withColumn("known", F.coalesce("known", "node")), "known")
    # round two: what isn't in a group's largest class meets every part of its group
    counted = large.groupBy("comp", "known").agg(F.count("*").alias("k"))
    main = counted.groupBy("comp").agg(F.max_by("known", F.struct("k", "known")).alias("main"))
    rest = large.join(main, "comp").where("known <> main")
    shares = rest.groupBy("comp").agg(F.ceil(F.sum("n") / block).cast("int").alias("shares"))
    rest = rest.join(shares, "comp").withColumn("share", F.pmod(F.xxhash64("node", F.lit(2)), F.col("shares")).cast("int"))
    rest = rest.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    base = large.join(shares, "comp").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    pick = [name("comp", "part", "share"), F.col("node"), F.col("known"), F.col("body")]
    second = _join_blocks(base.select(*pick).unionByName(rest.select(*pick)), percent)
    links = first.unionByName(second)
    labels = connected_components(links).select("node", F.col("component").alias("label"))
    return found.unionByName(labels)


def text_keys(text: str) -> list[Column]:
    """Two independent 64-bit keys of a text, null as empty: text_key and text_mark."""
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(body).alias("text_key"), F.xxhash64(F.lit(1), body).alias("text_mark")]


def classes_of_rows(docs: DataFrame, width: int = WIDTH, percent: int = 75, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, text_mark, n, label, copies, component_id) of each row of docs (doc_id, text).

    text_key and text_mark are text_keys of the text.

    label names the row's class, whether or not a row of it has a doc_id; it and copies
    are null for rows that are alone.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *text_keys("text"))
    frequent, total = frequencies(docs, width)
    several = np.zeros(0, np.int64)
    while True:
        members, edges = sketch(docs, width, percent, frequent, total, several)
        nodes = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min("mark").alias("low"), F.max("mark").alias("high"), F.min("text_key").alias("text_key"), F.first("n").alias("n"))
        nodes = store(nodes, "nodes")
        # sets share a signature about once in 2^63 pairs: none up to billions of documents, some tens beyond
        more = nodes.where("low <> high").select("node").limit(KEYS).toArrow().column("node").to_numpy()
        if not len(more):
            break
        several = np.union1d(several, more)

    def named() -> DataFrame:
        labels = similar_nodes(docs, members, nodes, edges, width, percent, frequent, several, block).dropDuplicates(["node"])
        own = nodes.select("node", "least", "copies").join(labels, "node", "left").where("copies > 1 or label is not null")
        own = store(own.withColumn("label", F.coalesce("label", "node")), "nodes")
        classes_ = own.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
        return join_hot(own.select("node", "label", "copies"), classes_, "label", "size", "inner").select("node", "label", "component_id", "copies")

    linked = join_hot(members.where("node is not null"), settled(spark, "named", named), "node", "copies", "left").select("doc_id", "text_key", "text_mark", "n", "label", "copies", "component_id")
    none = F.lit(None).cast("long")
    alone = members.where("node is null").select("doc_id", "text_key", "text_mark", "n", none.alias("label"), none.alias("copies"), none.alias("component_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = 75, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs (doc_id, text)."""
    both = classes_of_rows(docs, width, percent, block)
    return both.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
