"""First row per key wins. Neither form brings all rows of a hot key together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_rows(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row of each key. The rank limit is applied on the map side too, so a hot key sends at most one
    row per map task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_of(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``first_rows`` for rows of nothing but the key and the column to order by: the least, without a sort."""
    none = F.count(by) < F.count(F.lit(1))  # NULL comes first
    return rows.groupBy(*keys).agg(F.when(~none, F.min(by)).alias(by)).select(*rows.columns)


def winners(rows: DataFrame, keys: list[str], seq: str, existing: DataFrame | None = None) -> DataFrame:
    """``seq`` of the rows that win their key: least seq of the key, and the key is not in ``existing`` yet."""
    firsts = rows.groupBy(*keys).agg(F.min(seq).alias(seq))
    if existing is not None:
        firsts = firsts.join(existing.select(*keys), keys, "left_anti")
    return firsts.select(seq)


def mark_winners(rows: DataFrame, candidate: Column, keys: list[str], seq: str, flag: str,
                 existing: DataFrame | None = None) -> DataFrame:
    """Add a boolean: this row is a candidate and wins its key. Joined on the unique ``seq``, never on the key."""
    won = winners(rows.filter(candidate), keys, seq, existing).withColumn(flag, F.lit(True))
    return rows.join(won, seq, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
