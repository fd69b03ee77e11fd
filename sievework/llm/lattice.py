"""Near-duplicate vectors by lattice hashing: E8 cells of random projections, probed and verified.

Unit vectors are projected to eight dimensions by a random matrix per table and decoded
to the nearest point of a scaled E8 lattice. A vector stands in its own cell and in the
`probes` neighbouring cells it is nearest to; vectors of a label that share a cell of
some table are compared by their cosine in double precision. A pair counts in the first
cell it shares only, so links are counted where they are found and no pair is ever sent
on: a cell gives one row per vector and a spanning forest.

Cells are counted first, as bare numbers; vectors then go only to cells that more than one
class stands in, in the precision they came in. Equal vectors of a label are one class
with a count; a class is a 64-bit key, which a second key divides where different vectors
share it. Cells of more than `block` classes are compared in pairs of parts (all links
of such a cell are counted, so work grows with its square). With these parameters a pair
at cosine 0.93 is found with probability over 0.95, nearer ones more often; nothing below
the threshold links.

Vectors that are null, empty or zero, or hold nulls or non-finite values, and vectors
without a label link with nothing. Vectors of different lengths link with nothing; any
length will do. Repeated rows are vectors of their own. Rows without vec_id belong to
components but do not name them. Columns other than these three play no part, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import bounded, has_rows, join_hot, row_key, settled, store, trim
from .components import connected_components

TABLES = 4
PROBES = 2
#: Lattice scale in standard deviations of a projected coordinate of a unit vector.
SCALE = 1.7
#: Classes compared at once in a cell.
BLOCK = 4096
#: Pairs of a block looked at in one piece.
PIECE = 2_000_000
#: Shared cells, or keys of repeated vectors, that are broadcast at most (8 bytes each).
KEYS = 2_000_000


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0^6) and halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    y = np.rint(x)
    odd = np.flatnonzero(np.mod(y.sum(axis=1), 2) != 0)
    if len(odd):
        off = x[odd] - y[odd]
        k = np.abs(off).argmax(axis=1)
        rows = np.arange(len(odd))
        y[odd, k] += np.where(off[rows, k] >= 0, 1.0, -1.0)
    return y


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


class Hasher:
    """Cell ids of unit vectors of one length."""

    def __init__(self, size: int, tables: int, probes: int, scale: float):
        self.turns = np.random.default_rng(size).standard_normal((tables, size, 8)) / scale
        self.near, self.probes = minimal_vectors(), probes

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, 1 + probes) ids; the own cell first."""
        out = np.empty((len(unit), len(self.turns), 1 + self.probes), np.uint64)
        for t, turn in enumerate(self.turns):
            x = unit @ turn
            own = nearest_e8(x)
            points = [own]
            if self.probes:
                gain = (x - own) @ self.near.T
                best = np.argpartition(-gain, self.probes, axis=1)[:, : self.probes]
                points += [own + self.near[best[:, p]] for p in range(self.probes)]
            for p, point in enumerate(points):
                h = np.full(len(unit), t + 1, np.uint64)
                for k in range(8):
                    h = kernels.mix(h * kernels._BASE + (point[:, k] * 2).astype(np.int64).view(np.uint64))
                out[:, t, p] = h
        return out


def _hashed(classes: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """classes with ids, all cells of a class, and body, its vector, instead of label and embedding."""
    kind = np.float32 if classes.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            label, lists = np.asarray(batch.column(3)), batch.column(4)
            sizes = np.asarray(pc.list_value_length(lists))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                x = np.asarray(lists.take(pa.array(rows)).flatten()).reshape(len(rows), size)
                wide = x.astype(np.float64)
                unit = wide / np.sqrt((wide * wide).sum(axis=1))[:, None]
                if size not in hashers:
                    hashers[size] = Hasher(size, tables, probes, scale)
                ids = hashers[size].cells(unit)
                ids = kernels.mix(ids ^ kernels.mix(label[rows].astype(np.int64).view(np.uint64) + np.uint64(size))[:, None, None])
                ids.sort(axis=2)
                k = ids.shape[1] * ids.shape[2]
                cells = pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) * k + 1, k, dtype=np.int32)), pa.array(ids.reshape(-1).view(np.int64)))
                own = x.astype(kind)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(pa.array(rows)) for i in range(3)], cells, pa.array([v.tobytes() for v in own], pa.binary())], names=["cls", "least", "n", "ids", "body"])
        trim()

    return classes.select("cls", "least", "n", "label", "embedding").mapInArrow(run, "cls long, least long, n long, ids array<long>, body binary")


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label (each one's least known relative, itself a root) with the pairs (a, b) joined."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def _first_shared(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The first cell, by table and then number, that is among both p's and q's (pair, table, cell)."""
    none = np.iinfo(np.uint64).max
    out = np.full(len(p), none, np.uint64)
    for t in range(p.shape[1]):
        for i, j in product(range(p.shape[2]), repeat=2):
            same = (p[:, t, i] == q[:, t, j]) & (p[:, t, i] < out)
            if t:
                same &= ~done
            out[same] = p[same, t, i]
        done = out != none
    return out


def compare(vectors: np.ndarray, counts: np.ndarray, ids: np.ndarray, side: np.ndarray, cell: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, first): vectors linked to each for which this is the first shared cell, and each one's class here.

    side tells the two parts of a split cell apart (-1: not split).
    """
    m = len(vectors)
    wide = vectors.astype(np.float64)
    unit = wide / np.sqrt((wide * wide).sum(axis=1))[:, None]
    links, label = np.zeros(m), np.arange(m)
    here = np.uint64(cell & (1 << 64) - 1)
    step = max(1, PIECE // m)
    for begin in range(0, m, step):
        a, b = np.nonzero(unit[begin : begin + step] @ unit[begin:].T >= least)
        a, b = a + begin, b + begin
        ok = (a < b) & ((side[a] < 0) | (side[a] != side[b]))
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 200_000):
            i, j = a[at : at + 200_000], b[at : at + 200_000]
            mine = _first_shared(ids[i], ids[j]) == here
            i, j = i[mine], j[mine]
            links += np.bincount(i, counts[j], m) + np.bincount(j, counts[i], m)
        label = _joined(label, a, b)
    return links.astype(np.int64), label


def _compare_blocks(rows: DataFrame, shape: tuple[int, int], width: str, least: float) -> DataFrame:
    """(a, b, links) of each class in a block (block, side, cell, cls, n, body, ids); width: the type of body's numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close() -> None:
            if len(held) < 2:
                return
            cls = np.array([h[2] for h in held], np.int64)
            vectors = np.frombuffer(b"".join([h[4] for h in held]), width).reshape(len(held), -1)
            ids = np.array([h[5] for h in held]).view(np.uint64).reshape(len(held), *shape)
            links, label = compare(vectors, np.array([h[3] for h in held], np.int64), ids, np.array([h[0] for h in held]), held[0][1], least)
            some = np.flatnonzero((links > 0) | (label != np.arange(len(label))))
            if len(some):
                out.append((cls[some], cls[label[some]], links[some]))

        def rows_() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64)) for k in range(3)], names=["a", "b", "links"])
            out.clear()
            return made

        for batch in batches:
            ids = np.asarray(batch.column(6).flatten()).reshape(len(batch), -1)
            for i, (block, *rest) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:6]], strict=True)):
                if block != now:
                    close()
                    now, held = block, []
                held.append([*rest, ids[i]])
            yield rows_()
        close()
        yield rows_()
        trim()

    dealt = rows.select("block", "side", "cell", "cls", "n", "body", "ids").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "a long, b long, links long")


def _keyed(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, again): vec_id, embedding, label and cls (null: links with nothing) of each row; cls and n of repeated vectors."""
    finite = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable = F.col("label").isNotNull() & finite & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    rows = rows.withColumn("cls", F.when(usable, row_key("label", "embedding"))).withColumn("mark", row_key("label", "embedding", seed=1))
    while True:
        counted = rows.where("cls is not null").groupBy("cls").agg(F.count("*").alias("n"), F.min("mark").alias("low"), F.max("mark").alias("high"))
        again = store(counted.where("n > 1"), "again")
        several = again.where("low <> high").select("cls")
        if not has_rows(several):
            return rows.drop("mark"), again.select("cls", "n")
        # different vectors share a key about once in 2^64 pairs: there are few
        hit = F.broadcast(several.withColumn("_several", F.lit(True)))
        rows = rows.join(hit, "cls", "left").withColumn("cls", F.when(F.col("_several"), F.xxhash64("cls", "mark")).otherwise(F.col("cls"))).drop("_several")


def near_vectors(vectors: DataFrame, cosine: float = 0.93, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows, again = _keyed(vectors)
    named = settled(spark, "named", lambda: _named(rows, again, cosine, tables, probes, scale, block))
    whole = join_hot(rows.where("cls is not null").select("vec_id", "cls"), named, "cls", "copies", "left")
    linked = F.col("copies").isNotNull()
    whole = whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(linked, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    alone = rows.where("cls is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _named(rows: DataFrame, again: DataFrame, cosine: float, tables: int, probes: int, scale: float, block: int) -> DataFrame:
    """(cls, copies, n_links, component_id) of classes that have links or copies."""
    usable, few = rows.where("cls is not null"), bounded(again, KEYS)
    keys = F.broadcast(again.select("cls")) if few else again.select("cls")
    columns = ["cls", "least", "n", "label", "embedding"]
    single = usable.join(keys, "cls", "left_anti").withColumn("n", F.lit(1).cast("long")).withColumnRenamed("vec_id", "least").select(columns)
    several = usable.join(keys, "cls", "left_semi").groupBy("cls").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = store(_hashed(single.unionByName(several.select(columns)), tables, probes, scale), "classes")

    # bare numbers first: most cells hold one class, and no vector goes there
    shared = store(classes.select(F.explode("ids").alias("cell")).groupBy("cell").agg(F.count("*").alias("of")).where("of > 1"), "shared")
    parts = F.when(F.col("of") > block, F.ceil(F.col("of") / block).cast("int")).alias("parts")
    cells = classes.withColumn("cell", F.explode("ids"))
    if bounded(shared, KEYS):
        cells = cells.join(F.broadcast(shared.select("cell", parts)), "cell")
    else:
        own = join_hot(classes.select("cls", F.explode("ids").alias("cell")), shared, "cell", "of", "inner").select("cls", F.struct("cell", parts).alias("c"))
        own = own.groupBy("cls").agg(F.collect_list("c").alias("cs"))  # as many as a class has cells
        cells = classes.join(own, "cls").withColumn("c", F.explode("cs")).select(*classes.columns, "c.cell", "c.parts")
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    # a part meets itself and every other part once
    others = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    split = cells.withColumn("part", part).withColumn("other", F.explode(others))
    text = lambda c: c.cast("string")
    pair = F.concat_ws(":", text(F.col("cell")), text(F.least("part", "other")), text(F.greatest("part", "other")))
    blocks = split.withColumn("block", F.when(F.col("parts").isNull(), text(F.col("cell"))).otherwise(pair))
    blocks = blocks.withColumn("side", F.when(F.col("parts").isNull() | (F.col("part") == F.col("other")), F.lit(-1)).otherwise((F.col("part") > F.col("other")).cast("int")))
    width = "<f4" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    found = store(_compare_blocks(blocks, (tables, 1 + probes), width, cosine), "links")

    labels = connected_components(found.select("a", "b")).select(F.col("node").alias("cls"), F.col("component").alias("comp"))
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links")).join(labels, "cls", "left")
    own = classes.select("cls", "least", "n").join(links, "cls", "left").where("n > 1 or links is not null")
    own = store(own.withColumn("comp", F.coalesce("comp", "cls")), "own")
    components = own.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("of"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    return join_hot(own, components, "comp", "of", "inner").select("cls", F.col("n").alias("copies"), n_links.alias("n_links"), "component_id")
