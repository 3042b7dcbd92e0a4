"""Loaders from feeds to operational tables.

A feed is a DataFrame in the layout of its declared feed table plus ``seq``, its dense row number in file order. A
loader judges every row: it comes back once, with its resolved ids and either a new id or a reject reason.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.expressions import availability
from ..session import cut_lineage
from .dedupe import mark_winners
from .lookup import first_reason, in_turn, lookup_join, prepare_key
from .quality import apply_defaults, column_checks
from .surrogate import highest, number_rows

REASON = "reject_reason"
CORRUPT = "_corrupt_record"  # text of a row that did not parse, if staging keeps such rows
PLATE = {"vehicle_license_plate": "license_plate"}


class ConstraintViolation(ValueError):
    """A row breaks a constraint that aborts the whole load."""


@dataclass(frozen=True)
class Load:
    """Judged rows of one feed. ``judged`` is read once per use: cut its lineage before using several of these."""

    table: S.Table
    feed: S.Table
    judged: DataFrame
    batch_ts: datetime | str

    def accepted(self) -> DataFrame:
        """New rows in the layout of the target table."""
        passed = self.judged.filter(F.col(REASON).isNull())
        given = [c for c in self.table.names if c in passed.columns]
        return apply_defaults(passed.select(*given), self.table, self.batch_ts)

    def rejects(self) -> DataFrame:
        """Reject log: feed, row number, reason and the raw row."""
        raw = F.to_json(F.struct(*self.feed.names), {"ignoreNullFields": "false"})
        if CORRUPT in self.judged.columns:
            raw = F.coalesce(CORRUPT, raw)
        return self.judged.filter(F.col(REASON).isNotNull()).select(
            F.lit(self.feed.name).alias("feed"), "seq", F.col(REASON).alias("reason"), raw.alias("raw"))

    def outcome(self) -> DataFrame:
        """Row counts: accepted, and rejected by reason."""
        return outcome(self.judged, self.feed.name)

    def require_clean(self) -> None:
        """Raise if a row broke a column constraint: one such row fails the load, unlike a lookup miss or duplicate."""
        broken = self.judged.filter(F.col(REASON).rlike("^(not_null|length):")).select("seq", REASON)
        first = broken.orderBy("seq").limit(1).collect()
        if first:
            raise ConstraintViolation(f"{self.feed.name} row {first[0]['seq']}: {first[0][REASON]}")


def outcome(judged: DataFrame, feed: str) -> DataFrame:
    reason = F.coalesce(REASON, F.lit("accepted"))
    return judged.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(feed).alias("feed"), "outcome", "rows")


def _judge(rows: DataFrame, table: S.Table, misses: list[tuple[Column, str]]) -> DataFrame:
    """Reasons that one row shows by itself: one given while staging, lookup misses in their order, constraints.

    The result is written out: repeats and numbers are found in several passes that should not look up again.
    """
    own = first_reason(misses + column_checks(table, rows.columns))
    return cut_lineage(rows.withColumn(REASON, F.coalesce(REASON, own) if REASON in rows.columns else own))


def _reject_repeats(rows: DataFrame, keys: list[str], code: str, existing: DataFrame) -> DataFrame:
    """The first row of a key passes if the target lacks the key; all others are repeats."""
    open_rows = F.col(REASON).isNull()
    marked = mark_winners(rows, open_rows, keys, "seq", "_won", existing)
    repeat = F.when(~F.col("_won"), F.lit(code))
    return marked.withColumn(REASON, F.coalesce(REASON, repeat)).drop("_won")


def _number(rows: DataFrame, table: S.Table, existing: DataFrame, where: Column) -> DataFrame:
    return number_rows(rows, "seq", table.primary_key, highest(existing, table.primary_key), where)


def load_customers(feed: DataFrame, customer: DataFrame, batch_ts: datetime | str) -> Load:
    """Customers; the first row of an e-mail wins. A repeated e-mail still uses up an id."""
    rows = _judge(feed, S.CUSTOMER, [])
    rows = _number(rows, S.CUSTOMER, customer, F.col(REASON).isNull())
    judged = _reject_repeats(rows, ["email"], "duplicate_email", customer)
    return Load(S.CUSTOMER, S.CUSTOMER_FEED, judged, batch_ts)


def load_vehicles(feed: DataFrame, vehicle: DataFrame, vehicle_type: DataFrame, branch: DataFrame,
                  batch_ts: datetime | str) -> Load:
    """Vehicles; type and branch by name, the first row of a plate wins. A repeated plate still uses up an id."""
    rows = in_turn(
        feed,
        prepare_key(feed, vehicle_type, {"vehicle_type_name": "type_name"}, "vehicle_type_id"),
        prepare_key(feed, branch, {"branch_name": "name"}, "branch_id"),
    )
    rows = rows.withColumn("rental_availability", availability(F.col("rental_status_text")))
    rows = _judge(rows, S.VEHICLE, [
        (F.col("vehicle_type_id").isNull(), "unknown_vehicle_type"), (F.col("branch_id").isNull(), "unknown_branch"),
    ])
    rows = _number(rows, S.VEHICLE, vehicle, F.col(REASON).isNull())
    judged = _reject_repeats(rows, ["license_plate"], "duplicate_license_plate", vehicle)
    return Load(S.VEHICLE, S.VEHICLE_FEED, judged, batch_ts)


def load_rentals(feed: DataFrame, rental: DataFrame, customer: DataFrame, vehicle: DataFrame, employee: DataFrame,
                 batch_ts: datetime | str) -> Load:
    """Rentals; customer and employee by name, vehicle by plate. Same vehicle and dates is a repeat."""
    customer_key = {"customer_first_name": "first_name", "customer_last_name": "last_name"}
    employee_key = {"employee_first_name": "first_name", "employee_last_name": "last_name"}
    rows = in_turn(
        feed,
        prepare_key(feed, customer, customer_key, "customer_id"),
        prepare_key(feed, vehicle, PLATE, "vehicle_id"),
        prepare_key(feed, employee, employee_key, "employee_id"),
    )
    rows = _judge(rows, S.RENTAL, [
        (F.col("customer_id").isNull(), "unknown_customer"), (F.col("vehicle_id").isNull(), "unknown_vehicle"),
        (F.col("employee_id").isNull(), "unknown_employee"),
    ])
    judged = _reject_repeats(rows, ["vehicle_id", "rental_start_date", "rental_end_date"], "duplicate_rental", rental)
    judged = _number(judged, S.RENTAL, rental, F.col(REASON).isNull())
    return Load(S.RENTAL, S.RENTAL_FEED, judged, batch_ts)


def load_payments(feed: DataFrame, payment: DataFrame, rental: DataFrame, vehicle: DataFrame,
                  batch_ts: datetime | str, idempotent: bool = False) -> Load:
    """Payments; vehicle by plate, rental by vehicle and start date. Loading a file again adds its payments again,
    unless ``idempotent``, which drops payments equal in every column to one the target has."""
    rows = prepare_key(feed, vehicle, PLATE, "vehicle_id")(feed)
    rental_key = {"vehicle_id": "vehicle_id", "rental_start_date": "rental_start_date"}
    rows = prepare_key(rows, rental, rental_key, "transaction_id")(rows)
    rows = _judge(rows, S.PAYMENT, [
        (F.col("vehicle_id").isNull(), "unknown_vehicle"), (F.col("transaction_id").isNull(), "unknown_rental"),
    ])
    if idempotent:
        same = ["transaction_id", "payment_date", "amount", "payment_method"]
        known = payment.select(*same).distinct().withColumn("_known", F.lit(True))
        rows = lookup_join(rows, known, same, counted=payment).withColumn(
            REASON, F.coalesce(REASON, F.when(F.col("_known"), F.lit("duplicate_payment")))).drop("_known")
    judged = _number(rows, S.PAYMENT, payment, F.col(REASON).isNull())
    return Load(S.PAYMENT, S.PAYMENT_FEED, judged, batch_ts)


def load_maintenance(feed: DataFrame, maintenance: DataFrame, vehicle: DataFrame, batch_ts: datetime | str) -> Load:
    """Maintenance; vehicle by plate. Same vehicle, day and service type is a repeat."""
    rows = prepare_key(feed, vehicle, PLATE, "vehicle_id")(feed)
    rows = _judge(rows, S.MAINTENANCE, [(F.col("vehicle_id").isNull(), "unknown_vehicle")])
    judged = _reject_repeats(rows, ["vehicle_id", "service_date", "service_type"], "duplicate_maintenance", maintenance)
    judged = _number(judged, S.MAINTENANCE, maintenance, F.col(REASON).isNull())
    return Load(S.MAINTENANCE, S.MAINTENANCE_FEED, judged, batch_ts)
