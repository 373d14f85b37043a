"""Minimax contiguous partition of atomic groups into shards, in DataFrame operations alone.

A group is all rows of equal text (all rows with one 64-bit hash of it, so equal texts never part).  Groups stand in the
order of their hash.  A group that is larger than an equal share of what is left has a shard of its own.  The others are cut
into contiguous shards: the smallest capacity is found by binary search, each capacity is checked greedily.

The check needs the running sizes of all groups only around the cuts.  So sizes are added up per hash prefix, which gives a
bounded number of cells whatever the input; a cell that cannot be cut gives an upper bound of the capacity, one that can be
cut anywhere a lower bound.  While they differ, only the cells in which a greedy cut can lie are split by further bits.
Equal bounds prove the smallest capacity.

Defined results: a null text is an empty one; repeated rows are rows of one group; with fewer groups than shards some
shards stay empty; an empty table gives no rows.
"""

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelline.llm.common import whole
from gavelline.session import cut

#: Bits of the first cells, and bits by which a cell is split.
FIRST_BITS, MORE_BITS = 14, 8
#: Rows that are numbered together.
PIECE_ROWS = 50_000


class Cell(NamedTuple):
    """All groups whose hash starts with a prefix."""

    start: int
    bits: int
    size: int
    single: bool


def cells_of(groups: DataFrame, bits: int, inside: list[Cell] | None = None) -> list[Cell]:
    """Sizes per prefix of so many bits, of all groups or of those inside the given cells (of equal bits)."""
    if inside:
        shift = 64 - inside[0].bits
        groups = groups.filter(F.shiftright("_hash", shift).isin([c.start >> shift for c in inside]))
    prefix = F.shiftright("_hash", 64 - bits).alias("prefix")
    found = groups.groupBy(prefix).agg(F.sum("_size").alias("size"), F.min("_hash").alias("a"), F.max("_hash").alias("b"))
    return [Cell(r.prefix << (64 - bits), bits, r["size"], r.a == r.b) for r in found.collect()]


def greedy(cells: list[Cell], ends: list[int], capacity: int, shards: int, split: bool) -> list[int]:
    """Where each shard ends when filled as far as the capacity allows.

    split: cells of several groups can be cut anywhere.
    """
    at, cuts = 0, []
    for _ in range(shards):
        k = bisect_right(ends, at + capacity)
        if k == len(ends):
            at = ends[-1] if ends else 0
        elif split and not cells[k].single:
            at += capacity
        else:
            at = max(at, ends[k] - cells[k].size)
        cuts.append(at)
    return cuts


def smallest_capacity(cells: list[Cell], ends: list[int], shards: int, split: bool) -> int:
    total = ends[-1] if ends else 0
    low, high = 0, total
    while low < high:
        middle = (low + high) // 2
        if greedy(cells, ends, middle, shards, split)[-1] == total:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the hashes at which a new shard begins, over rows of (_hash, _size)."""
    cells = sorted(cells_of(groups, FIRST_BITS))
    while True:
        ends = list(accumulate(c.size for c in cells))
        least = smallest_capacity(cells, ends, shards, True)
        loose = {i for i, c in enumerate(cells) if not c.single and c.size * 8 > least}
        if not loose:
            enough = smallest_capacity(cells, ends, shards, False)
            if least == enough:
                break
            low, high = greedy(cells, ends, least, shards, False), greedy(cells, ends, enough, shards, True)
            for a, b in zip(low, high):
                near = range(max(0, bisect_right(ends, a) - 1), min(len(ends), bisect_right(ends, b) + 1))
                loose |= {i for i in near if not cells[i].single}
        finer = []
        for bits in {cells[i].bits for i in loose}:
            finer += cells_of(groups, min(64, bits + MORE_BITS), [cells[i] for i in loose if cells[i].bits == bits])
        cells = sorted([c for i, c in enumerate(cells) if i not in loose] + finer)
    begins = [bisect_right(ends, at) for at in greedy(cells, ends, least, shards, False)[:-1]]
    return least, [cells[k].start for k in begins if k < len(cells)]


def own_shards(groups: DataFrame, shards: int) -> list[int]:
    """Hashes of the groups larger than an equal share of what is left, the largest first; fewer than shards."""
    total = groups.agg(F.sum("_size").alias("size")).first()["size"] or 0
    largest = groups.groupBy("_hash").agg(F.sum("_size").alias("size")).orderBy(F.desc("size"), "_hash").limit(shards - 1)
    own = []
    for r in largest.collect():
        if r["size"] * (shards - len(own)) <= total:
            break
        own.append(r["_hash"])
        total -= r["size"]
    return own


def shard_of(groups: DataFrame, shards: int) -> Column:
    """The shard of a row as an expression of its _hash."""
    own = own_shards(groups, shards)
    _, starts = minimax_cuts(groups.filter(~F.col("_hash").isin(own)) if own else groups, shards - len(own))
    shard = F.lit(len(own))
    for start in starts:
        shard = shard + F.when(F.col("_hash") >= start, 1).otherwise(0)
    for k, value in enumerate(own):
        shard = F.when(F.col("_hash") == value, k).otherwise(shard)
    return shard.cast("int")


def numbered(sharded: DataFrame) -> DataFrame:
    """Adds slot, a gapless number from 0 within each shard, without numbering a whole shard in one task."""
    most = sharded.groupBy("shard").count().agg(F.max("count").alias("n")).first()["n"] or 0
    pieces = 1 + most // PIECE_ROWS
    pieced = sharded.withColumn("_piece", F.pmod(F.xxhash64("doc_id", "_hash"), F.lit(pieces)).cast("int"))
    counts = pieced.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(counts.select("shard", "_piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    rank = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("doc_id", "_hash")) - 1
    slot = (F.col("_before") + rank).cast("bigint")
    return pieced.join(starts, ["shard", "_piece"]).withColumn("slot", slot)


def shard_documents(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, shard and slot."""
    text = whole(F.col("text"))
    digests = documents.select(
        "doc_id", F.xxhash64(text).alias("_hash"), (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    digests = cut(digests)
    sharded = digests.withColumn("shard", shard_of(digests.withColumnRenamed("size", "_size"), shards))
    return numbered(sharded).select("doc_id", "size", "text_crc32", "shard", "slot")
