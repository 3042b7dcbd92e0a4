"""Constraint checks on DataFrames."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.expressions import instant
from .lookup import any_null


def column_checks(table: S.Table, available: list[str]) -> list[tuple[Column, str]]:
    """Row-level checks of the columns present: required values, then length limits."""
    columns = [c for c in table.columns if c.name in available]
    missing = [(F.col(c.name).isNull(), f"not_null:{c.name}") for c in columns if c.required]
    long = [(F.length(c.name) > c.limit, f"length:{c.name}") for c in columns if c.limit is not None]
    return missing + long


def fits_price(value: Column) -> Column:
    """True where a number, given as text or number, fits the money columns."""
    return value.isNull() | value.try_cast("decimal(10,2)").isNotNull()


def apply_defaults(rows: DataFrame, table: S.Table, batch_ts: datetime | str) -> DataFrame:
    """Add the columns of the table that ``rows`` lacks, with their defaults. An explicit NULL stays NULL."""
    given = set(rows.columns)

    def value(c: S.Col) -> Column:
        if c.name in given:
            return F.col(c.name)
        if c.default is S.NOW:
            return instant(batch_ts).alias(c.name)
        return F.lit(c.default).cast(c.type).alias(c.name)

    return rows.select(*[value(c) for c in table.columns])


def _one(table: str, rule: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.col("violations").cast("long"))


def row_rules(rows: DataFrame, table: str, checks: list[tuple[Column, str]]) -> DataFrame:
    """Violations per row-level rule, all rules in one scan."""
    sums = rows.agg(*[F.count(F.when(failed, 1)).alias(f"_{i}") for i, (failed, _) in enumerate(checks)])
    pairs = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations")) for i, (_, rule) in enumerate(checks)
    ])
    return sums.select(F.explode(pairs).alias("r")).select(F.lit(table).alias("table"), "r.rule", "r.violations")


def unique_rule(rows: DataFrame, table: str, keys: list[str], rule: str = "unique") -> DataFrame:
    """Rows beyond the first of each key. Keys holding a NULL never collide."""
    sizes = rows.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    extra = sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    return _one(table, f"{rule}:{','.join(keys)}", extra)


def foreign_rule(child: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent lacks. Rows are counted per key before the join."""
    sizes = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count(F.lit(1)).alias("n"))
    orphans = sizes.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return _one(table, f"foreign_key:{column}", orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct key values of the child that the parent lacks, with their row counts."""
    sizes = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def key_groups(rows: DataFrame, keys: list[str], parent: DataFrame | None = None, parent_key: str | None = None) -> DataFrame:
    """Each key without NULLs with its number of rows, ``n``, and ``orphan``, whether the parent lacks it: one grouped pass for
    every rule on the key. Rows are counted before the join, so no key is hot."""
    sizes = rows.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if parent is None:
        return sizes.withColumn("orphan", F.lit(False))
    known = parent.select(F.col(parent_key).alias(keys[0])).filter(F.col(keys[0]).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return sizes.join(known, keys, "left").withColumn("orphan", F.col("_known").isNull()).drop("_known")


def _key_rules(table: S.Table, tables: dict[str, DataFrame]) -> dict[tuple[str, ...], dict[str, tuple[str, str] | None]]:
    """The declared rules by the key they are on: their names, with parent and parent key of a foreign key."""
    found: dict[tuple[str, ...], dict[str, tuple[str, str] | None]] = {}
    if table.primary_key is not None:
        found.setdefault((table.primary_key,), {})[f"primary_key:{table.primary_key}"] = None
    for keys in table.unique:
        found.setdefault(tuple(keys), {})[f"unique:{','.join(keys)}"] = None
    for column, target in table.foreign.items():
        if target[0] in tables:
            found.setdefault((column,), {})[f"foreign_key:{column}"] = target
    return found


def _grouped(rows: DataFrame, keys: tuple[str, ...], rules: dict, tables: dict[str, DataFrame]) -> DataFrame:
    target = next((t for t in rules.values() if t is not None), None)
    return key_groups(rows, list(keys)) if target is None else key_groups(rows, list(keys), tables[target[0]], target[1])


def constraint_report(tables: dict[str, DataFrame], declared: dict[str, S.Table]) -> DataFrame:
    """Violations per declared rule: required values and lengths in one scan of a table, and all rules on one key (primary,
    unique, foreign) in one grouped pass."""
    parts = []
    for name, rows in tables.items():
        table = declared[name]
        checks = column_checks(table, rows.columns)
        if checks:
            parts.append(row_rules(rows, name, checks))
        for keys, rules in _key_rules(table, tables).items():
            sums = _grouped(rows, keys, rules, tables).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.coalesce(F.sum(F.when(F.col("orphan"), F.col("n"))), F.lit(0)).alias("orphans"))
            pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col("extra" if target is None else "orphans").alias("violations"))
                              for rule, target in rules.items()])
            parts.append(sums.select(F.explode(pairs).alias("r")).select(
                F.lit(name).alias("table"), "r.rule", F.col("r.violations").cast("long").alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def offending_keys(tables: dict[str, DataFrame], declared: dict[str, S.Table]) -> DataFrame:
    """The keys that break a declared rule, as text, with their number of rows."""
    parts = []
    for name, rows in tables.items():
        for keys, rules in _key_rules(declared[name], tables).items():
            groups = _grouped(rows, keys, rules, tables)
            shown = F.concat_ws(",", *[F.col(k).cast("string") for k in keys]).alias("key")
            broken = [F.when(F.col("n") > 1 if target is None else F.col("orphan"), F.lit(rule)) for rule, target in rules.items()]
            parts.append(groups.select(F.lit(name).alias("table"), F.explode(F.array_compact(F.array(*broken))).alias("rule"), shown,
                                       F.col("n").alias("rows")))
    return reduce(DataFrame.unionByName, parts)
