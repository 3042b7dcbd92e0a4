"""Exact top-k search in binary codes by incremental multi-index hashing.

Method: a code is cut into segments of about log2(codes) bits, each indexed by its value. A query probes the values that
differ from its own in 0, 1, 2, ... bits. After radius r - 1 in all m segments and radius r in the first s of them every code
within Hamming distance mr + s - 1 has been met: one that was not differs by more than r in those s and by r or more in the
others. So at each radius a query probes just the segments that cover its kth distance so far, and is finished if these are
not more than there are. Codes beyond that distance leave the join no more. Everything is joins and windows over DataFrames.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.staging import staged

NEIGHBOURS = 10
BITS = 64
#: Masks of one radius up to which they are broadcast with the queries (16 bytes each).
BROADCAST_MASKS = 2_000_000


def sign_codes(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """vec_id and code: bit i is set if component i is positive. Vectors that are null, zero, of another length, or hold
    null or non-finite components have no code and are left out."""
    v = F.col("embedding")
    good = v.isNotNull() & (F.size(v) == bits) & F.forall(
        v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    code = F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, (a, i) -> a | shiftleft(cast(embedding[i] > 0 as bigint), i))")
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), code.alias("code"))


class Segments:
    """Offsets and widths of the segments of a code."""

    def __init__(self, bits: int, codes: int):
        number = min(bits, max(1, math.ceil(bits / max(1.0, math.log2(max(2, codes))))))
        edges = [bits * s // number for s in range(number + 1)]
        self.parts = [(s, a, b - a) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]
        self.widest = max(w for _, _, w in self.parts)

    def __len__(self) -> int:
        return len(self.parts)

    @staticmethod
    def value(code: Column, offset: int, width: int) -> Column:
        return F.shiftrightunsigned(code, offset).bitwiseAND(F.lit(-1 if width == 64 else (1 << width) - 1))

    def spread(self, df: DataFrame) -> DataFrame:
        """A row per segment: seg and its value in key."""
        parts = [F.struct(F.lit(s).alias("seg"), self.value(F.col("code"), a, w).alias("key")) for s, a, w in self.parts]
        return df.select("*", F.inline(F.array(*parts)))

    def masks(self, spark, radius: int) -> DataFrame:
        """(seg, mask): all masks of so many bits within each segment."""
        df = spark.createDataFrame([(s, w, 0, -1) for s, _, w in self.parts], "seg int, width int, mask long, top int")
        for _ in range(radius):
            df = (df.where(F.col("top") + 1 < F.col("width"))
                  .select("seg", "width", "mask", F.explode(F.sequence(F.col("top") + 1, F.col("width") - 1)).alias("top"))
                  .withColumn("mask", F.col("mask").bitwiseOR(F.expr("shiftleft(1L, top)"))))
        return df.select("seg", "mask")

    def size_at(self, radius: int) -> int:
        return sum(math.comb(w, radius) for _, _, w in self.parts)

    def met_first(self, radius: int) -> Column:
        """Whether asked and code meet at this radius in segment seg and neither at a smaller one nor in an earlier segment:
        so every pair is met once."""
        conditions = []
        for s, a, w in self.parts:
            apart = F.bit_count(self.value(F.col("asked").bitwiseXOR(F.col("code")), a, w))
            conditions.append((F.col("seg") == s) | F.when(F.col("seg") > s, apart > radius).otherwise(apart >= radius))
        total = conditions[0]
        for c in conditions[1:]:
            total = total & c
        return total


def top_k(codes: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, bits: int = BITS) -> DataFrame:
    """The k nearest codes of each query by Hamming distance among all rows but those with its own id: query_id, rank from 1,
    vec_id, distance; ties go to the smaller vec_id; all rows if fewer.

    codes, queries: vec_id, code (up to 64 bits in a long); other columns are ignored. Rows without id or code take no part,
    repeated rows count once. Empty tables give no rows. The result is exact.
    """
    spark = codes.sparkSession
    rows = codes.where(F.col("vec_id").isNotNull() & F.col("code").isNotNull()).groupBy("code", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    # k + 1 rows of a code are enough: more of them can't be among k besides the query's own
    first = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    distinct = staged(rows.withColumn("first", first).where(F.col("first") <= k + 1)
                      .groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids")))
    size = distinct.agg(F.count(F.lit(1)).alias("codes"), F.sum(F.size("vec_ids")).alias("rows")).first()
    asked = staged(queries.where(F.col("vec_id").isNotNull() & F.col("code").isNotNull())
                   .select(F.col("vec_id").cast("long").alias("query_id"), F.col("code").alias("asked")).distinct())
    segments = Segments(bits, size["codes"])
    enough = min(k + 1, size["rows"] or 0)
    index = staged(segments.spread(distinct))
    number = len(segments)
    active, best, finished = staged(asked.select("asked").distinct().withColumn("need", F.lit(number)).withColumn("bound", F.lit(bits))), None, None
    nearest = Window.partitionBy("asked").orderBy("distance", "vec_id")
    for radius in range(segments.widest + 1):
        masks = segments.masks(spark, radius)
        if segments.size_at(radius) <= BROADCAST_MASKS:
            masks = F.broadcast(masks)
        probes = (segments.spread(active.select("asked", "need", "bound", F.col("asked").alias("code")))
                  .where(F.col("seg") < F.col("need")).drop("code", "need").join(masks, "seg")
                  .select("asked", "bound", "seg", F.col("key").bitwiseXOR(F.col("mask")).alias("key")))
        distance = F.bit_count(F.col("asked").bitwiseXOR(F.col("code")))
        met = (probes.join(index, ["seg", "key"]).where((distance <= F.col("bound")) & segments.met_first(radius))
               .select("asked", distance.alias("distance"), F.explode("vec_ids").alias("vec_id")))
        met = met if best is None else met.union(best)
        best = staged(met.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).drop("place"))
        state = active.join(best.groupBy("asked").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("last")), "asked", "left")
        covered = F.col("last") <= number * radius + F.col("need") - 1
        done = (F.col("n") >= enough) & (covered | F.lit(enough == (size["rows"] or 0)))
        after = F.when(F.col("n") >= enough, F.least(F.lit(number), F.col("last") - number * (radius + 1) + 1)).otherwise(number)
        bound = F.when(F.col("n") >= enough, F.col("last"))
        state = staged(state.select("asked", F.coalesce(done, F.lit(False)).alias("done"),
                                    F.coalesce(after, F.lit(number)).cast("int").alias("need"),
                                    F.coalesce(bound, F.lit(bits)).cast("int").alias("bound")))
        some = best.join(state.where("done").select("asked"), "asked", "left_semi")
        finished = some if finished is None else finished.union(some)
        active = state.where("NOT done").select("asked", "need", "bound")
        best = best.join(active.select("asked"), "asked", "left_semi")
        if not active.limit(1).count():
            break
    finished = finished.union(best)
    answers = asked.join(finished, "asked").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id")).cast("int")
    return (answers.select("query_id", rank.alias("rank"), "vec_id", F.col("distance").cast("int").alias("distance"))
            .where(F.col("rank") <= k))
