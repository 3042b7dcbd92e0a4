"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

#: Values of a range: few enough for the rows of a small table to fill all tasks.
WIDTH = 1 << 16
#: Ranges of a block. A window over one task sees the blocks; 64-bit ids fill at most 8 million of them.
BLOCK = 1 << 24


def _offsets(sizes: DataFrame) -> DataFrame:
    """Rows before each range, from ranges with their row counts. Ids may be sparse, with nearly as many ranges as rows,
    so the running sum is taken in blocks of ranges and then over the blocks."""
    blocked = sizes.withColumn("_block", F.expr(f"_range div {BLOCK}"))
    up_to = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("_block").agg(F.sum("_n").alias("_n")).select(
        "_block", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_blocks_before"))
    before = Window.partitionBy("_block").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = blocked.withColumn("_ranges_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return ranges.join(blocks, "_block").select(
        "_range", (F.col("_ranges_before") + F.col("_blocks_before")).alias("_offset"))


def number_rows(rows: DataFrame, by: str, into: str, start: int = 0, where: Column | None = None,
                width: int = WIDTH) -> DataFrame:
    """Number rows start+1, start+2, ... in the order of the unique integer column ``by``.

    Rows are cut into ranges of ``width`` consecutive values of ``by``: as values are unique, no range holds more rows
    than that, and the range of a row depends on the row alone, so a recomputed task gives the same numbers. The
    offsets come from one count per range. Rows failing ``where`` stay and get no number. ``rows`` is read twice: cut
    its lineage first if it is expensive.
    """
    counted = F.lit(1) if where is None else F.when(where, 1).otherwise(0)
    cut = rows.withColumn("_range", F.expr(f"`{by}` div {width}"))
    sizes = cut_lineage(cut.groupBy("_range").agg(F.sum(counted).alias("_n")))
    within = Window.partitionBy("_range").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The window has partitioned the rows by range already; only the offsets move for the join.
    running = cut.withColumn("_running", F.sum(counted).over(within))
    number = (F.col("_running") + F.col("_offset") + F.lit(start)).cast("long")
    if where is not None:
        number = F.when(where, number)
    return running.join(_offsets(sizes), "_range").withColumn(into, number).drop("_range", "_running", "_offset")


def highest(table: DataFrame, key: str) -> int:
    """Greatest key in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
