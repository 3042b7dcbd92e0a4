"""Groups of rows that are compared with each other: dealing them out in blocks, reading them together, comparing their sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key from which on they are joined by broadcast, at least; there are at most HOT_KEYS such keys.
HOT_ROWS = 100_000
HOT_KEYS = 10_000


def matching(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is one of keys (a row each; n is the number of rows that have it), with the columns of keys. Keys of very
    many rows are broadcast, so their rows don't meet in one task."""
    size = keys.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    least = max(HOT_ROWS, (size["all"] or 0) // HOT_KEYS)
    if (size["most"] or 0) <= least:
        return rows.join(keys, on)
    hot = F.broadcast(keys.where(F.col("n") > least))
    names = [on, *rows.drop(on).columns, *keys.drop(on).columns]
    cold = rows.join(hot.select(on), on, "left_anti").join(keys, on)
    return rows.join(hot, on).select(names).union(cold.select(names))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, in batches that come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def linked(alike: np.ndarray) -> np.ndarray:
    """The first member of each member's component in a symmetric relation."""
    label = np.full(alike.shape[0], -1)
    for first in range(alike.shape[0]):
        if label[first] >= 0:
            continue
        label[first] = first
        reached = np.array([first])
        while reached.size:
            reached = np.flatnonzero(alike[reached].any(axis=0) & (label < 0))
            label[reached] = first
    return label


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Minimum hashes, a row of so many for each value of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def blocks(df: DataFrame, size: str, keys: list[str], block: int) -> DataFrame:
    """Members of a group in columns i <= j: every pair of members meets in a block of about 2 block members at most.

    A group up to block is one block; each member of a larger one is repeated once per block members.
    """
    parts = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("block")), parts).cast("int")
    spread = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return (spread.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .repartition(*(F.col(k) for k in (*keys, "i", "j"))).sortWithinPartitions(*keys, "i", "j"))


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many elements each two sets share."""
    owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    new = np.r_[True, element[1:] != element[:-1]][:element.size]
    number = np.cumsum(new) - 1
    shared = np.bincount(number, minlength=1)[number] > 1 if element.size else np.empty(0, bool)
    owner, number = owner[shared], number[shared]
    if number.size:
        number = np.cumsum(np.r_[True, number[1:] != number[:-1]]) - 1
    counts = np.zeros((len(sets), len(sets)), np.float32)
    edges = np.searchsorted(number, np.arange(0, (number[-1] if number.size else -1) + columns + 1, columns))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if b > a:
            part = np.zeros((len(sets), number[b - 1] - k * columns + 1), np.float32)
            part[owner[a:b], number[a:b] - k * columns] = 1
            counts += part @ part.T
    return counts.astype(np.int64)
