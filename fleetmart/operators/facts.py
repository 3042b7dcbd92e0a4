"""Star-schema facts from operational rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .asof import prepare_at_batch, prepare_at_event
from .lookup import Step, any_null, first_reason, in_turn, prepare_lookup
from .rollups import payment_rollup

RENTAL_KEY = ["customer_id", "vehicle_id", "employee_id", "rental_start_date_id", "rental_end_date_id"]
MAINTENANCE_KEY = ["vehicle_id", "maintenance_date_id", "service_type"]


def _prepare_version(base: DataFrame, dim: DataFrame, on: str, key: str, batch_ts, asof: str, at: str,
                     inclusive: bool) -> Step:
    if asof == "batch":
        return prepare_at_batch(base, dim, on, {key: key}, batch_ts, inclusive)
    return prepare_at_event(base, dim, on, {key: key}, at, inclusive)


def _prepare_date(base: DataFrame, dim_date: DataFrame, on: str, into: str) -> Step:
    # One row per calendar day: bounded by construction.
    lookup = dim_date.select(F.col("full_date").alias(on), F.col("date_id").alias(into))
    return prepare_lookup(base, lookup, [on], bounded=True)


def resolve_rentals(rentals: DataFrame, payments: DataFrame, customers: DataFrame, vehicles: DataFrame,
                    employees: DataFrame, dim_date: DataFrame, batch_ts: datetime | str, asof: str = "batch",
                    inclusive: bool = True, paid: DataFrame | None = None) -> DataFrame:
    """Every rental with its payments rolled up and its dimension keys; ``unresolved`` names the first missing key.

    ``asof='batch'`` takes the versions valid at the batch time, ``'event'`` those valid at the rental start. ``paid`` are the
    payments as they are rolled up already, if they are; it may hold more rentals.
    """
    paid = payment_rollup(payments) if paid is None else paid
    rows = resolve_keys(rentals, customers, vehicles, employees, dim_date, batch_ts, asof, inclusive)
    return unresolved(with_paid(rows, paid), RENTAL_KEY)


def resolve_keys(rentals: DataFrame, customers: DataFrame, vehicles: DataFrame, employees: DataFrame, dim_date: DataFrame,
                 batch_ts: datetime | str, asof: str = "batch", inclusive: bool = True) -> DataFrame:
    """Every rental with its dimension keys, without its payments."""
    base = rentals.select(
        F.col("transaction_id").alias("source_id"), F.col("customer_id").alias("source_customer"),
        F.col("vehicle_id").alias("source_vehicle"), F.col("employee_id").alias("source_employee"),
        "rental_start_date", "rental_end_date",
    )
    roles = ((customers, "source_customer", "customer_id"), (vehicles, "source_vehicle", "vehicle_id"),
             (employees, "source_employee", "employee_id"))
    return in_turn(
        base,
        *[_prepare_version(base, dim, on, key, batch_ts, asof, "rental_start_date", inclusive)
          for dim, on, key in roles],
        _prepare_date(base, dim_date, "rental_start_date", "rental_start_date_id"),
        _prepare_date(base, dim_date, "rental_end_date", "rental_end_date_id"),
    )


def with_paid(rows: DataFrame, paid: DataFrame) -> DataFrame:
    """Rows of rentals with what is paid for them."""
    return rows.join(paid.withColumnRenamed("transaction_id", "source_id"), "source_id", "left")


def unresolved(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``unresolved``, the first of the keys that is missing."""
    return rows.withColumn("unresolved", first_reason([(F.col(k).isNull(), k) for k in keys]))


def resolve_maintenance(maintenance: DataFrame, vehicles: DataFrame, dim_date: DataFrame, batch_ts: datetime | str,
                        asof: str = "batch", inclusive: bool = True) -> DataFrame:
    """Every maintenance row with its dimension keys; ``unresolved`` names the first missing key."""
    base = maintenance.select(
        F.col("maintenance_id").alias("source_id"), F.col("vehicle_id").alias("source_vehicle"), "service_date",
        "service_type", "maintenance_cost", "notes",
    )
    rows = in_turn(
        base,
        _prepare_version(base, vehicles, "source_vehicle", "vehicle_id", batch_ts, asof, "service_date", inclusive),
        _prepare_date(base, dim_date, "service_date", "maintenance_date_id"),
    )
    return unresolved(rows, MAINTENANCE_KEY[:2])


def resolved(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with all keys. Stated on the keys themselves, so the left lookups above turn into inner joins."""
    return rows.filter(~any_null(keys))
