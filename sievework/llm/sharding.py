"""Balanced label propagation: linked documents move to their neighbours' shards under quotas.

Links are given as groups: rows with equal link values are neighbours of one another.
Each row begins in a shard of its own hash, so nearly all links are cut at first. Rows of
a group that stand in the same shard are a cell and move together; a group too large for a
shard to take or leave at once begins as cells of at most a 64th of a quota (or COARSE rows), side by side.
In each round Spark adds up neighbours by group and shard and joins the sums back; a cell
asks for the shard with most of its neighbours, of equal ones that which the group's hash
prefers in this round, so that its cells agree. What is asked from each shard of each other one is a
table of shards by shards: as much as is asked in both directions changes places, beyond
that a shard admits what it has room for, and lots decide which cells go. Cells that lots
draw from a shard over its quota must ask for one with room. Rounds end when nothing moves
(or after ROUNDS, which only leaves more to the last step). Only shard-by-shard sums come
to the driver. Last, rows over a quota and all rows without links fill what room is left,
by gapless numbers, so counts end at most one apart (law "rows") whatever the links.

Null text has no bytes; texts of any length count by digest. Repeated rows are neighbours
like any equal texts, and each gets its own place; rows without doc_id are rows like
others. Columns other than doc_id and text play no part, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, settled, store
from .ranks import rank_within

SHARDS = 16
ROUNDS = 12
#: Cells that a shard's quota holds at least.
FINE = 64
#: A cell has so many rows at least.
COARSE = 8
#: The part of a quota that rounds may put on top of it; the last step moves it, group by group, to where room is left.
SLACK = 32
#: Rows that one task numbers.
BUCKET = 2000
_LOTS = 1 << 20

log = logging.getLogger(__name__)


def _lot(*of: Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(_LOTS))


def _pick(values: list, at: Column) -> Column:
    """values[at], null for a null `at`; element_at would pass for never null under ANSI rules."""
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def admitted_shares(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], float]:
    """Of what is asked from shard to shard the part that may go: exchanges in full, beyond them what there is room for."""
    swap = {(s, t): min(n, asked.get((t, s), 0)) for (s, t), n in asked.items()}
    more: dict[int, int] = {}
    for (s, t), n in asked.items():
        more[t] = more.get(t, 0) + n - swap[s, t]
    return {(s, t): (swap[s, t] + (n - swap[s, t]) * min(1.0, max(0, room[t]) / max(1, more[t]))) / n for (s, t), n in asked.items()}


def propagate(cells: DataFrame, link: str, shards: int, quota: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(cells (link, part, size, shard) with the shards they have moved to, rows that asked and rows that moved in each round)."""
    now, history = store(cells, "cells"), []
    slack = -(-quota[0] // SLACK)
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    for turn in range(rounds):
        load = {r[0]: r[1] for r in now.groupBy("shard").agg(F.sum("size")).collect()}  # one row per shard
        room = [quota[s] + slack - load.get(s, 0) for s in range(shards)]
        over = [int(_LOTS * max(0, -room[s]) / max(1, load.get(s, 0))) for s in range(shards)]
        near = F.array(*[F.sum(F.when(F.col("shard") == s, F.col("size")).otherwise(0)) for s in range(shards)])
        # a group has a cell in each shard, or, where it is large, one for each 64th of a quota
        sums = now.groupBy(link).agg(near.alias("near"))
        asked = now.join(sums, link).withColumn("drawn", _lot(F.col(link), F.col("part"), F.lit(turn)) < _pick(over, F.col("shard")))
        # in every other round shards without room may be asked as well, in exchange
        free = lambda s: _pick([r > 0 for r in room], s) | (~F.col("drawn") & F.lit(turn % 2 == 0))
        may = lambda s: F.when(s == F.col("shard"), ~F.col("drawn")).otherwise(free(s))
        value = lambda s: F.struct(F.get("near", s).alias("n"), F.when(F.col("drawn"), F.xxhash64(link, "part", F.lit(turn), s)).otherwise(F.xxhash64(link, s, F.lit(turn))).alias("t"), s.alias("s"))
        choice = F.array_max(F.transform(every, lambda s: F.when(may(s), value(s))))
        asked = asked.withColumn("want", F.when(choice["s"] != F.col("shard"), choice["s"]))
        asked = store(asked.select(link, "part", "size", "shard", "want"), "asked")
        table = {(r[0], r[1]): r[2] for r in asked.where("want is not null").groupBy("shard", "want").agg(F.sum("size")).collect()}  # shards x shards rows
        share = admitted_shares(table, room)
        lots = F.array(*[F.lit(int(_LOTS * share.get((s, t), 0.0))) for s in range(shards) for t in range(shards)])
        goes = F.col("want").isNotNull() & (_lot(F.col("part"), F.col(link), F.lit(-turn - 1)) < F.get(lots, (F.col("shard") * shards + F.col("want")).cast("int")))
        moved = asked.withColumn("moved", F.coalesce(goes, F.lit(False)))
        now = store(moved.select(link, "part", "size", F.when(F.col("moved"), F.col("want")).otherwise(F.col("shard")).alias("shard"), F.when(F.col("moved"), F.col("size")).otherwise(0).alias("gone")), "cells")
        history.append((sum(table.values()), now.agg(F.coalesce(F.sum("gone"), F.lit(0))).first()[0]))
        now = now.drop("gone")
        log.info("round %s: rows of %s asked to move, %s moved", turn + 1, *history[-1])
        if (turn % 2 == 0 and not history[-1][0]) or (turn and not any(n for _, n in history[-2:])):
            break
    return now, history


def fill(linked: DataFrame, single: DataFrame, link: str, shards: int, quota: list[int]) -> DataFrame:
    """All rows with shard and slot: linked rows stay within quotas, the others fill the room."""
    whole = linked.unionByName(single.withColumn("part", F.lit(None).cast("int")).withColumn("shard", F.lit(shards)))
    whole = store(whole, "placed")
    sizes = {r[0]: r[1] for r in whole.groupBy("shard").count().collect()}  # one row per shard
    # numbers go cell by cell, so what is over a quota is whole cells but for one
    spread = F.when(F.col("part").isNull(), F.xxhash64("_row")).otherwise(F.xxhash64(link, "part"))
    buckets = _pick([max(1, sizes.get(s, 0) // BUCKET) for s in range(shards + 1)], F.col("shard"))
    ranked = rank_within(whole, "shard", [F.col(link), F.col("part"), F.col("_row")], spread, buckets, "_rank")
    kept = [min(sizes.get(s, 0), quota[s]) for s in range(shards)]
    # rows over quota, then rows without links, are numbered through: the pool
    pool, begins = 0, []
    for s in range(shards + 1):
        begins.append(pool - (kept[s] if s < shards else 0))
        pool += sizes.get(s, 0) - (kept[s] if s < shards else 0)
    keep = F.array(*[F.lit(k).cast("long") for k in [*kept, 0]])
    begin = F.array(*[F.lit(b).cast("long") for b in begins])
    at = F.get(begin, F.col("shard")) + F.col("_rank")
    # the pool's numbers fall into the shards' rooms one after the other
    to, slot, edge = [], [], 0
    for s in range(shards):
        room = quota[s] - kept[s]
        inside = (at >= edge) & (at < edge + room)
        to.append(F.when(inside, F.lit(s)))
        slot.append(F.when(inside, at - edge + kept[s]))
        edge += room
    stays = F.col("_rank") < F.get(keep, F.col("shard"))
    rest = [c for c in whole.columns if c not in ("shard", "part", "_row")]
    return ranked.select(*rest, F.when(stays, F.col("shard")).otherwise(F.coalesce(*to)).cast("int").alias("shard"), F.when(stays, F.col("_rank")).otherwise(F.coalesce(*slot)).alias("slot"))


def shard_rows(rows: DataFrame, link: str, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """rows with shard and slot, counts at most one apart, rows of equal link together where quotas allow."""
    return settled(rows.sparkSession, "sharded", lambda: _sharded(rows, link, shards, rounds))


def _sharded(rows: DataFrame, link: str, shards: int, rounds: int) -> DataFrame:
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "nodes")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    cell = max(COARSE, quota[0] // FINE)
    groups = store(rows.groupBy(link).agg(F.count("*").alias("copies")).where("copies > 1"), "groups")
    # groups larger than a cell: shards x FINE at most, and twice as many cells
    large = F.broadcast(groups.where(F.col("copies") > cell).select(link))
    ranked = rank_within(rows.join(large, link, "left_semi"), link, [F.col("_row")], F.col("_row"), F.lit(max(8, total // (BUCKET * shards))), "_rank")
    parted = ranked.withColumn("part", F.floor(F.col("_rank") / cell).cast("int")).withColumn("_large", F.lit(True)).drop("_rank")
    rest = store(join_hot(rows.join(large, link, "left_anti"), groups.where(F.col("copies") <= cell), link, "copies", "left"), "rest")
    own = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int")
    small = rest.where("copies is not null").withColumn("part", own).withColumn("_large", F.lit(False))
    columns = [*rows.columns, "part", "_large"]
    linked = store(parted.select(*columns).unionByName(small.select(*columns)), "linked")
    # a large group's cells stand side by side, as many in a shard as its quota takes
    beside = F.pmod(F.pmod(F.xxhash64(link), F.lit(shards)) + F.floor(F.col("part") / max(1, quota[0] // cell)), F.lit(shards)).cast("int")
    cells = linked.groupBy(link, "part", "_large").agg(F.count("*").alias("size")).select(link, "part", "size", F.when(F.col("_large"), beside).otherwise(F.col("part")).alias("shard"))
    cells, _ = propagate(cells, link, shards, quota, rounds)
    placed = linked.join(cells.select(link, "part", "shard"), [link, "part"])  # a cell has few rows
    placed = placed.withColumn("part", F.when(F.col("_large"), F.col("part")).otherwise(0)).drop("_large")
    return fill(placed, rest.where("copies is null").drop("copies"), link, shards, quota)


def cut_pairs(placed: DataFrame, link: str) -> DataFrame:
    """One row: pairs of rows with equal link, and how many of them stand in two shards."""
    at = placed.groupBy(link, "shard").agg(F.count("*").alias("n")).groupBy(link).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("together"))
    both = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return at.agg(both(F.expr("n * (n - 1) div 2")).alias("pairs"), both(F.expr("(n * n - together) div 2")).alias("cut"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, link) of docs (doc_id, text); links are equal texts."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    nodes = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.md5(body).alias("link"))
    placed = shard_rows(nodes, "link", shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "link")
