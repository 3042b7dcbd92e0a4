"""Change extraction by high-water mark, and updates that stamp the rows they touch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import EPOCH, instant
from .lookup import lookup_join


def watermarks(control: DataFrame) -> DataFrame:
    """Latest load time per source table, over runs of any status."""
    return control.groupBy("source_table").agg(F.max("last_etl_time").alias("last_etl_time"))


def watermark(control: DataFrame, source_table: str) -> DataFrame:
    """One row, one column: the mark of a table, or the epoch if it was never loaded."""
    latest = control.filter(F.col("source_table") == source_table)
    return latest.agg(F.coalesce(F.max("last_etl_time"), instant(EPOCH)).alias("watermark"))


def changed_since(source: DataFrame, mark: datetime | str, overlap: str | None = None,
                  stamp: str = "last_modified") -> DataFrame:
    """Rows stamped strictly after the mark. The mark is a literal, so the filter reaches the scan.

    ``overlap`` (an interval such as ``'10 minutes'``) reads back behind the mark for rows committed late.
    """
    since: Column = instant(mark)
    if overlap is not None:
        since = since - F.expr(f"INTERVAL {overlap}")
    return source.filter(F.col(stamp) > since)


def boundary(rows: DataFrame, key: str, stamp: str = "last_modified", earlier: DataFrame | None = None) -> DataFrame:
    """What to remember of rows that were read: the greatest stamp, and the keys read at it (``mark``, ``key``), with those an
    ``earlier`` boundary holds at the same stamp. A few rows, unless very many rows carry the greatest stamp. No rows: the earlier
    boundary."""
    read = rows.select(F.col(stamp).alias("mark"), F.col(key).alias("key")).filter(F.col("mark").isNotNull())
    if earlier is not None:
        read = read.unionByName(earlier.select("mark", "key"))
    greatest = read.agg(F.max("mark").alias("mark"))
    return read.join(F.broadcast(greatest), "mark").distinct()


def changed_from(source: DataFrame, mark: DataFrame, key: str, stamp: str = "last_modified") -> DataFrame:
    """Rows stamped after a boundary, and those stamped at it that were not read then: a row that turns up late with the very
    stamp of the last one read is not lost, and none is read twice. Without a boundary all rows that have a stamp.

    The stamp is a literal, so the filter reaches the scan; only rows at the boundary itself look for their key."""
    at = mark.agg(F.max("mark")).first()[0]
    if at is None:
        return source.filter(F.col(stamp).isNotNull())
    read = mark.select(F.col("key").alias(key), F.lit(True).alias("_read")).distinct()
    later = source.filter(F.col(stamp) > instant(at))
    equal = lookup_join(source.filter(F.col(stamp) == instant(at)), read, [key]).filter(F.col("_read").isNull()).drop("_read")
    return later.unionByName(equal)


def apply_updates(base: DataFrame, updates: DataFrame, key: str, batch_ts: datetime | str,
                  stamp: str = "last_modified") -> DataFrame:
    """Set the columns of ``updates`` on the rows they name. A touched row gets the batch time as its stamp, even if no
    value differs; the others keep theirs. ``updates`` must be unique on the key: a key given twice, or none, is an
    error, raised here."""
    if updates.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull()).limit(1).count():
        raise ValueError(f"the updates hold a {key} more than once, or none")
    given = [c for c in updates.columns if c != key]
    renamed = updates.select(key, *[F.col(c).alias(f"_{c}") for c in given], F.lit(True).alias("_touched"))
    hit = F.coalesce(F.col("_touched"), F.lit(False))
    columns = []
    for name in base.columns:
        if name == stamp:
            columns.append(F.when(hit, instant(batch_ts)).otherwise(F.col(name)).alias(name))
        elif name in given:
            columns.append(F.when(hit, F.col(f"_{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return base.join(renamed, key, "left").select(*columns)
