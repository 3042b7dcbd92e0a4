"""Key lookups: many rows against a table with one row per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 4  # a key is hot if it holds more than this part of what a task of the shuffle takes on average: 1 in 4
SPREAD = 1 << 20
KEY_GROUPS = 16  # keys are counted in groups first, so many for each hot key there can be; only those of large groups one by one

Step = Callable[[DataFrame], DataFrame]


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about: texts and binaries as they are, 8 for everything else."""
    sized = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    parts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in sized]
    return reduce(Column.__add__, parts, F.lit(16 + 8 * (len(df.columns) - len(sized))).cast("long"))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most that many rows and bytes, by one aggregation over it."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_width(df)).alias("size")).first()
    return found["n"] <= max_rows and (found["size"] or 0) <= max_bytes


def any_null(names: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(n).isNull() for n in names])


def in_turn(rows: DataFrame, *steps: Step) -> DataFrame:
    return reduce(lambda done, step: step(done), steps, rows)


def prepare_lookup(base: DataFrame, lookup: DataFrame, on: list[str], bounded: bool = False,
                   counted: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> Step:
    """A step that left joins rows to a lookup unique on its key; every row comes back exactly once.

    A lookup of checked size is broadcast and the rows never move (``bounded`` skips the check for lookups whose size
    is fixed by construction; ``counted`` is a table with at least as many rows as the lookup that is cheaper to
    check). A larger one is joined by shuffle. Then rows with a key that holds more than a quarter of an average task's
    share take their values from a small broadcast (there are at most four such keys per task), and they and the rows without a key are spread over all tasks of that shuffle by a hash of the
    whole row, which is the same when a task runs again. (Rows equal in every column stay together; all callers here
    carry a row id.)

    ``base`` holds the keys of the rows to come. Steps over one base can be prepared together and applied in turn:
    finding the hot keys then reads the key columns of the base, not the result of the steps before.
    """
    if bounded or fits_broadcast(lookup if counted is None else counted, max_rows):
        return lambda rows: rows.join(F.broadcast(lookup), on, "left")
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_keys(base, on, tasks)
    added = [c for c in lookup.columns if c not in on]
    values = lookup.select(*on, *[F.col(c).alias(f"_hot_{c}") for c in added])
    if hot is None:
        values = values.withColumn("_hot", F.lit(True)).limit(0)
    else:
        values = values.join(F.broadcast(hot), on, "left_semi")
        values = cut_lineage(hot.join(F.broadcast(values), on, "left").withColumn("_hot", F.lit(True)))
    # Always 0, but not as a literal: that would be folded into the join condition and no longer partition the rows.
    cold = lookup.withColumn("_spread", F.pmod(F.xxhash64(*on), F.lit(1)).cast("int"))

    def step(rows: DataFrame) -> DataFrame:
        apart = F.col("_hot").isNotNull() | any_null(on)
        spread = F.when(apart, F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)) + 1).otherwise(0).cast("int")
        marked = rows.join(F.broadcast(values), on, "left").withColumn("_spread", spread)
        joined = marked.join(cold, [*on, "_spread"], "left")
        return joined.select(*rows.columns, *[
            F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in added])

    return step


def _hot_keys(base: DataFrame, on: list[str], tasks: int) -> DataFrame | None:
    """Keys with more rows than the hot share, None if there are none. A group of keys with no more rows holds no such key."""
    keyed = base.filter(~any_null(on)).select(*on, F.pmod(F.xxhash64(*on), F.lit(KEY_GROUPS * HOT_SHARE * tasks)).alias("_group"))
    groups = cut_lineage(keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")))
    total = groups.agg(F.sum("_n")).first()[0] or 0
    least = max(1, total // (HOT_SHARE * tasks))
    large = groups.filter(F.col("_n") > least).select("_group")
    if large.isEmpty():
        return None
    sizes = keyed.join(F.broadcast(large), "_group", "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(sizes.filter(F.col("_n") > least).select(*on))


def lookup_join(rows: DataFrame, lookup: DataFrame, on: list[str], **options) -> DataFrame:
    """One lookup, prepared on the rows themselves."""
    return prepare_lookup(rows, lookup, on, **options)(rows)


def natural_key(table: DataFrame, key: dict[str, str], id_column: str) -> DataFrame:
    """Lookup from a natural key to an id; of several matches the least id is taken.

    ``key`` maps the column name on the feed side to the column of ``table``.
    """
    renamed = table.select(*[F.col(c).alias(f) for f, c in key.items()], id_column)
    names = list(key)
    return renamed.filter(~any_null(names)).groupBy(*names).agg(F.min(id_column).alias(id_column))


def prepare_key(base: DataFrame, table: DataFrame, key: dict[str, str], id_column: str) -> Step:
    """A step that adds the id a natural key names in ``table``, NULL where it names none."""
    return prepare_lookup(base, natural_key(table, key, id_column), list(key), counted=table)


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    """Code of the first check that holds, NULL when none does."""
    return F.coalesce(*[F.when(failed, F.lit(code)) for failed, code in checks], F.lit(None).cast("string"))
