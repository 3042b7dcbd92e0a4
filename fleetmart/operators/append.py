"""Idempotent writes on a unique key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .dedupe import first_of, first_rows


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Rows of the batch to append: the first per key, and only for keys the target lacks.

    Both steps use the same partitioning by key; of the target only the key columns are read.
    """
    return first_rows(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column | str],
           update: list[str]) -> DataFrame:
    """Target with ``update`` columns taken from the batch where the key exists, plus the new rows of the batch."""
    new = first_rows(batch, keys, order)
    merged = target.withColumn("_old", F.lit(True)).alias("t").join(
        new.withColumn("_new", F.lit(True)).alias("b"), keys, "full_outer")
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
        elif name in update:
            columns.append(F.when(F.col("_new"), F.col(f"b.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        elif name in batch.columns:
            columns.append(F.when(F.col("_old"), F.col(f"t.{name}")).otherwise(F.col(f"b.{name}")).alias(name))
        else:
            columns.append(F.col(f"t.{name}").alias(name))
    return merged.select(*columns)


def append_delta(batch: DataFrame, target: DataFrame, keys: list[str], order: list[Column | str],
                 refresh: list[str], carried: dict[str, Column] | None = None) -> DataFrame:
    """The part of a batch that changes the target, in one join: rows with a new key, and, marked ``refreshes``, rows
    whose key is known with another value in a ``refresh`` column (NULL-safe). ``carried`` names what the target row
    gives along, NULL for new keys."""
    carried = carried or {}
    if not refresh:  # only the keys of the target count
        kinds = target.select(*[value.alias(name) for name, value in carried.items()]).schema
        bare = len(order) == 1 and isinstance(order[0], str) and sorted([*keys, *order]) == sorted(batch.columns)
        first = first_of(batch, keys, order[0]) if bare else first_rows(batch, keys, order)
        return first.join(target.select(*keys), keys, "left_anti").select(
            *batch.columns, F.lit(False).alias("refreshes"), *[F.lit(None).cast(kinds[c].dataType).alias(c) for c in carried])
    known = target.select(*keys, F.lit(True).alias("_known"), *[F.col(c).alias(f"_{c}") for c in refresh],
                          *[value.alias(name) for name, value in carried.items()])
    differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in refresh], F.lit(False))
    paired = first_rows(batch, keys, order).join(known, keys, "left")
    touched = paired.filter(F.col("_known").isNull() | differs)
    return touched.select(*batch.columns, F.col("_known").isNotNull().alias("refreshes"), *carried)
