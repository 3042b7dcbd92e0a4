"""What a load remembers of its source rows, so that only rows that differ are worked on again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOW_BITS = (1 << 31) - 1


def _order_free(columns: list[str]) -> list[Column]:
    """Number of rows and two sums over their hashes: the same for the same rows in any order, and combined on the map
    side. A row that stands twice counts twice. 31 bits each, so that no sum overflows."""
    each = F.xxhash64(*columns)
    parts = (each.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(each, 31).bitwiseAND(F.lit(LOW_BITS)))
    return [F.count(F.lit(1)), *[F.sum(p) for p in parts]]


def fingerprints(rows: DataFrame, key: str, starts: str, parts: DataFrame | None = None,
                 single: bool = False) -> DataFrame:
    """Per key of ``rows``: ``source_id``, a hash of its row and of its rows in ``parts`` (which hold the key, too, once if
    ``single``), and the date its event starts at. Parts of keys without a row are left out."""
    names = [c for c in rows.columns if c != key]
    own = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(f"_own{i}") for i, c in enumerate(_order_free(names))], F.max(starts).alias("starts"))
    hashed = [f"_own{i}" for i in range(3)]
    if parts is not None:
        names = [c for c in parts.columns if c != key]
        if single:
            held = parts.select(key, F.xxhash64(*names).alias("_part0"))
        else:
            held = parts.groupBy(key).agg(*[c.alias(f"_part{i}") for i, c in enumerate(_order_free(names))])
        own = own.join(held, key, "left")
        hashed += [c for c in held.columns if c != key]
    return own.select(F.col(key).alias("source_id"), F.xxhash64(*hashed).alias("fingerprint"), "starts")


def newest(log: DataFrame) -> DataFrame:
    """Of each source row the state of the last run that noted one; the log is only ever added to."""
    values = [c for c in log.columns if c not in ("source_id", "run")]
    return log.groupBy("source_id").agg(F.max_by(F.struct(*values), "run").alias("_s"), F.max("run").alias("run")).select(
        "source_id", "run", "_s.*")


def due(prints: DataFrame, known: DataFrame, since: Column) -> DataFrame:
    """Source rows to work on, with what is known of each: new and changed ones, open ones, and those whose event starts
    at ``since`` or later, as versions that begin from then on may be theirs."""
    told = known.select("source_id", F.col("fingerprint").alias("known_print"), "fact_id", "fact_month", "fact_print", "open")
    return prints.join(told, "source_id", "left").filter(
        ~F.col("fingerprint").eqNullSafe(F.col("known_print")) | F.col("open") | (F.col("starts") >= since))
