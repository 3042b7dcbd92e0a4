"""Shards of nearly equal size by a minimax contiguous partition.

Method: documents with equal texts form an atomic group, groups are ordered by a 64-bit hash of the text. The smallest
capacity under which a greedy pass needs no more shards than allowed is found by binary search; shards are cut where that
pass cuts.

The groups never reach the driver. It holds sums of ranges of hashes; a greedy pass over whole ranges gives an upper bound
of the capacity, one that may cut inside ranges a lower bound. Ranges that a cut could fall into are refined, until the
bounds are equal: then the cuts are those of the exact minimax partition. Equal texts are told by a 64-bit hash; should two
texts collide, they merely stay together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged

SHARDS = 16
#: Ranges of hashes that the first pass sums up, as a power of two, and the factor by which a range is refined.
FIRST_BITS = 14
MORE_BITS = 5
#: A document's place in its shard is counted in about so many cells of rows; groups too large for a cell are divided.
CELLS = 1 << 14


class Ranges:
    """Neighbouring ranges of the hash order: first hash, bits left inside, bytes, largest group, groups."""

    def __init__(self, first: np.ndarray, bits: np.ndarray, size: np.ndarray, largest: np.ndarray, groups: np.ndarray):
        order = np.argsort(first, kind="stable")
        self.first, self.bits, self.size, self.largest, self.groups = (x[order] for x in (first, bits, size, largest, groups))
        self.ends = np.cumsum(self.size)

    def greedy(self, capacity: int, shards: int, divide: bool) -> list[int] | None:
        """Bytes before each cut when every shard takes what fits; None if that takes more shards. divide: a range of
        several groups may be cut anywhere, as if its groups were as small as one likes."""
        total = int(self.ends[-1])
        cuts, at = [], 0
        while total - at > capacity:
            want = at + capacity
            k = int(np.searchsorted(self.ends, want, "right"))  # the range that doesn't fit as a whole
            whole = int(self.ends[k - 1]) if k else 0
            to = want if divide and self.groups[k] > 1 else whole
            if to <= at:
                return None
            cuts.append(to)
            at = to
            if len(cuts) >= shards:
                return None
        return cuts

    def least(self, shards: int, divide: bool) -> int:
        """The smallest capacity for which the greedy pass succeeds."""
        total = int(self.ends[-1])
        low, high = max(-(-total // shards), int(self.largest.max())), total
        while low < high:
            middle = (low + high) // 2
            if self.greedy(middle, shards, divide) is None:
                low = middle + 1
            else:
                high = middle
        return low


def _summed(groups: DataFrame, bits: int) -> DataFrame:
    """Per range with so many bits left inside."""
    return groups.groupBy(F.shiftright("group", bits).alias("range")).agg(
        F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.count(F.lit(1)).alias("groups"))


def _held(rows: list, bits: int) -> list[np.ndarray]:
    columns = [np.array([r[c] for r in rows], np.int64) for c in ("range", "bytes", "largest", "groups")]
    return [columns[0] << np.int64(bits), np.full(len(rows), bits), *columns[1:]]


def minimax_cuts(groups: DataFrame, shards: int = SHARDS) -> list[int]:
    """The first hash of each shard but shard 0, for groups (group, bytes); fewer if fewer shards suffice."""
    bits = 64 - FIRST_BITS
    rows = _summed(groups, bits).collect()  # at most 2 ** FIRST_BITS
    if not rows:
        return []
    ranges = Ranges(*_held(rows, bits))
    while True:
        low, high = ranges.least(shards, True), ranges.least(shards, False)
        if low == high:
            cuts = ranges.greedy(high, shards, False)
            return [int(ranges.first[np.searchsorted(ranges.ends, c, "right")]) for c in cuts]
        least, most = ranges.greedy(low, shards, False), ranges.greedy(high, shards, True)
        if least is None:  # whole ranges don't do at the lower bound: cuts lie no earlier than with one shard fewer each
            least = _earliest(ranges, low, len(most))
        open_ranges = np.zeros(ranges.first.size, bool)
        for a, b in zip(least, most):
            first = np.searchsorted(ranges.ends, min(a, b), "right")
            last = np.searchsorted(ranges.ends, b, "right")
            open_ranges[first:last + 1] = True
        open_ranges &= ranges.groups > 1
        # the widest of them, so that all left have the same width after some rounds
        widest = int(ranges.bits[open_ranges].max())
        chosen = open_ranges & (ranges.bits == widest)
        finer = max(0, widest - MORE_BITS)
        wanted = [int(x) >> widest for x in ranges.first[chosen]]
        session = groups.sparkSession
        keys = session.createDataFrame([(x,) for x in wanted], "range long")
        inside = groups.join(F.broadcast(keys), F.shiftright("group", widest) == F.col("range")).select("group", "bytes")
        more = _held(_summed(inside, finer).collect(), finer)
        old = [x[~chosen] for x in (ranges.first, ranges.bits, ranges.size, ranges.largest, ranges.groups)]
        ranges = Ranges(*(np.concatenate(x) for x in zip(old, more)))


def _earliest(ranges: Ranges, capacity: int, cuts: int) -> list[int]:
    """Cuts of whole ranges as far as they go: no exact greedy pass of this or a larger capacity cuts earlier."""
    found, at = [], 0
    for _ in range(cuts):
        k = int(np.searchsorted(ranges.ends, at + capacity, "right"))
        at = max(at, int(ranges.ends[min(k, ranges.ends.size) - 1]) if k else 0)
        found.append(at)
    return found


def _number_of(group: Column, cuts: list[int]) -> Column:
    number = F.lit(0)
    for cut in cuts:
        number = number + (group >= F.lit(cut)).cast("int")
    return number


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """Every row's shard so that the largest shard is as small as contiguous groups of equal texts allow.

    docs: doc_id, text; other columns are ignored. A row's size is its text's UTF-8 bytes plus 1, text_crc32 the CRC of those
    bytes; a null text has none. Null texts form one group, empty texts another. Repeated rows stay together, each with a
    slot of its own; slots count from 0 without gaps in every shard, by hash and doc_id. Trailing shards stay empty where
    fewer suffice, and an empty table gives no rows. grown_shard is null: the law is `bytes`.
    """
    text = F.col("text").cast("string")
    rows = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group")))
    groups = staged(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")))
    cuts = minimax_cuts(groups, shards)
    total = rows.count()
    # fewer groups than cells can have more rows than a cell should
    large = groups.where(F.col("rows") > max(1, total // cells)).select(
        "group", F.ceil(F.col("rows") * cells / max(1, total)).cast("int").alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.col("parts")), F.lit(0)).cast("int")
    placed = (rows.join(F.broadcast(large), "group", "left")  # at most as many as cells
              .select("doc_id", "size", "text_crc32", "group", _number_of(F.col("group"), cuts).alias("shard"),
                      F.shiftright("group", 64 - (cells.bit_length() - 1)).alias("range"),
                      F.when(F.col("parts").isNull(), F.lit(None)).otherwise(F.col("group")).alias("own"), part.alias("part")))
    cell = ["shard", "range", "own", "part"]
    number = [F.coalesce(F.col(c), F.lit(-(1 << 63))).alias(c) if c == "own" else F.col(c) for c in cell]
    placed = placed.select("doc_id", "size", "text_crc32", "group", *number)
    counts = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("range", "own", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("group", "doc_id")) - 1
    return (placed.withColumn("inside", inside).join(F.broadcast(offsets), cell)  # a few times as many as cells
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
