"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.expressions import changed, high_date, instant
from ..session import cut_lineage
from .lookup import fits_broadcast
from .surrogate import highest, number_rows


@dataclass(frozen=True)
class Dimension:
    """How one dimension follows its source table. ``compare`` names the tracked columns: True for a NULL-safe test."""

    source: S.Table
    table: S.Table
    compare: dict[str, bool]
    incremental: bool = False

    @property
    def business(self) -> list[str]:
        return [c.name for c in self.source.columns if c.name not in (self.source.primary_key, "last_modified")]

    def extract(self, source: DataFrame) -> DataFrame:
        return source.select(F.col(self.source.primary_key).alias("source_id"), *self.business)


VEHICLE_TYPE = Dimension(S.VEHICLE_TYPE, S.DIM_VEHICLE_TYPE, {"type_name": False, "description": True})
BRANCH = Dimension(S.BRANCH, S.DIM_BRANCH, {"name": False, "location": False, "contact_number": True})
CUSTOMER = Dimension(S.CUSTOMER, S.DIM_CUSTOMER, {
    "first_name": False, "last_name": False, "email": False, "phone_number": True, "address": True,
}, incremental=True)
VEHICLE = Dimension(S.VEHICLE, S.DIM_VEHICLE, {
    "make": False, "model": False, "production_year": False, "license_plate": False, "vehicle_type_id": False,
    "branch_id": False, "rental_availability": False,
}, incremental=True)
EMPLOYEE = Dimension(S.EMPLOYEE, S.DIM_EMPLOYEE, {
    "first_name": False, "last_name": False, "email": False, "phone_number": True, "branch_id": False,
})


@dataclass(frozen=True)
class Versioning:
    """Rules of a merge.

    ``reopen``: a changed key gets its new version in the same run; otherwise the old version is only closed.
    ``gap``: seconds between the end of a closed version and the batch time.
    ``first_from``: start of the first version of a key; None takes the batch time.
    """

    reopen: bool = True
    gap: int = 0
    first_from: str | None = None


CLOSE_ONLY = Versioning(reopen=False, gap=1)
CLOSE_AND_INSERT = Versioning()


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_to") == high_date())


def closed_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_to") != high_date())


def scd2_delta(current: DataFrame, source: DataFrame, spec: Dimension, batch_ts: datetime | str,
               rules: Versioning = CLOSE_AND_INSERT) -> DataFrame:
    """Versions this batch closes (``closing`` true, surrogate kept) or opens (surrogate NULL).

    Untouched versions are not part of the result, so the work after the join follows the size of the change. A small
    source first reduces the current versions by broadcast and the dimension is not shuffled.
    """
    now = instant(batch_ts)
    key = spec.table.primary_key
    if fits_broadcast(source):
        current = current.join(F.broadcast(source.select("source_id")), "source_id", "left_semi")
    pair = source.alias("s").join(current.alias("c"), F.col("s.source_id") == F.col("c.source_id"), "left")
    unknown = F.col("c.source_id").isNull()
    differs = reduce(Column.__or__, [
        changed(F.col(f"c.{name}"), F.col(f"s.{name}"), null_safe) for name, null_safe in spec.compare.items()
    ])

    def version(side: str, closing: bool) -> Column:
        fixed = {
            key: F.col(f"c.{key}"), "valid_from": F.col("c.valid_from"), "last_modified": F.col("c.last_modified"),
            "valid_to": now - F.expr(f"INTERVAL {rules.gap} SECOND"), "is_active": F.lit(False),
        } if closing else {
            key: F.lit(None).cast("long"), "valid_from": now, "last_modified": now, "valid_to": high_date(),
            "is_active": F.lit(True),
        }
        if not closing and rules.first_from is not None:
            fixed["valid_from"] = F.when(unknown, instant(rules.first_from)).otherwise(now)
        values = [fixed.get(name, F.col(f"{side}.{name}")).alias(name) for name in spec.table.names]
        return F.struct(*values, F.lit(closing).alias("closing"))

    opened, closed = version("s", False), version("c", True)
    touched = pair.filter(unknown | differs)
    if rules.reopen:
        rows = F.explode(F.when(unknown, F.array(opened)).otherwise(F.array(closed, opened)))
    else:
        rows = F.when(unknown, opened).otherwise(closed)
    return touched.select(rows.alias("v")).select("v.*")


def delta_counts(delta: DataFrame) -> tuple[int, int]:
    """Closed and opened versions. A source holding a key twice would close or open it twice: that is an error."""
    found = delta.groupBy("closing").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("source_id").alias("keys")).collect()
    if any(r["n"] != r["keys"] for r in found):
        raise ValueError("the source of a dimension holds a key more than once")
    counts = {r["closing"]: r["n"] for r in found}
    return counts.get(True, 0), counts.get(False, 0)


def number_versions(delta: DataFrame, spec: Dimension, start: int) -> DataFrame:
    """Delta rows in table layout, opened versions numbered after ``start`` in the order of their source ids."""
    key = spec.table.primary_key
    opened = number_rows(delta.filter(~F.col("closing")).drop(key), "source_id", key, start)
    return delta.filter("closing").select(*spec.table.names).unionByName(opened.select(*spec.table.names))


def scd2_merge(dim: DataFrame, source: DataFrame, spec: Dimension, batch_ts: datetime | str,
               rules: Versioning = CLOSE_AND_INSERT) -> DataFrame:
    """The whole dimension after the batch. Closed history takes no part in any join; the source is read once."""
    key = spec.table.primary_key
    current = current_versions(dim)
    delta = cut_lineage(scd2_delta(current, cut_lineage(source), spec, batch_ts, rules))
    closed, _ = delta_counts(delta)
    kept = current.join(delta.filter("closing").select(key), key, "left_anti") if closed else current
    return closed_versions(dim).unionByName(kept).select(*spec.table.names).unionByName(
        number_versions(delta, spec, highest(dim, key)))
