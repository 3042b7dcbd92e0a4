"""Declared tables: columns, types, length limits, defaults and keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

ID, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
FLAG, DAY, STAMP = T.BooleanType(), T.DateType(), T.TimestampNTZType()
PRICE = T.DecimalType(10, 2)

NOW = "batch time"  # default marker: the stamp of the running batch


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType = TEXT
    limit: int | None = None
    required: bool = False
    default: object = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    primary_key: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.struct)


def _text(name: str, limit: int | None = None, required: bool = False) -> Col:
    return Col(name, TEXT, limit, required)


def _key(name: str) -> Col:
    return Col(name, ID, required=True)


def _day(name: str) -> Col:
    return Col(name, DAY, required=True)


_TOUCHED = Col("last_modified", STAMP, default=NOW)
_VERSION = (
    Col("valid_from", STAMP, default=NOW),
    Col("valid_to", STAMP),
    Col("is_active", FLAG, default=True),
    Col("last_modified", STAMP, default=NOW),
)

# Column names, limits and keys below are the contract of the tables.

# --- CSV feeds, bound by position ---------------------------------------------------------------
CUSTOMER_FEED = Table("customer_feed", (
    _text("first_name", 50), _text("last_name", 50), _text("email", 100), _text("phone_number", 15),
    _text("address"),
))
VEHICLE_FEED = Table("vehicle_feed", (
    _text("make", 50), _text("model", 50), Col("production_year", INT), _text("license_plate", 20),
    _text("vehicle_type_name", 50), _text("branch_name", 100), _text("rental_status_text", 20),
))
RENTAL_FEED = Table("rental_feed", (
    _text("customer_first_name", 50), _text("customer_last_name", 50), _text("vehicle_make", 50),
    _text("vehicle_model", 50), _text("vehicle_license_plate", 20), _text("employee_first_name", 50),
    _text("employee_last_name", 50), Col("rental_start_date", DAY), Col("rental_end_date", DAY),
))
PAYMENT_FEED = Table("payment_feed", (
    _text("customer_name", 100), _text("vehicle_license_plate", 20), Col("rental_start_date", DAY),
    Col("payment_date", DAY), Col("amount", PRICE), _text("payment_method", 100),
))
MAINTENANCE_FEED = Table("maintenance_feed", (
    _text("vehicle_license_plate", 20), Col("service_date", DAY), _text("service_type", 100),
    Col("maintenance_cost", PRICE), _text("notes"),
))

# --- operational tables -------------------------------------------------------------------------
CUSTOMER = Table("customer", (
    _key("customer_id"), _text("first_name", 50, True), _text("last_name", 50, True),
    _text("email", 100, True), _text("phone_number", 15), _text("address"), _TOUCHED,
), "customer_id", unique=(("email",),))
BRANCH = Table("branch", (
    _key("branch_id"), _text("name", 100, True), _text("location", 255, True), _text("contact_number", 15),
), "branch_id")
EMPLOYEE = Table("employee", (
    _key("employee_id"), _text("first_name", 50, True), _text("last_name", 50, True),
    _text("email", 100, True), _text("phone_number", 15), _key("branch_id"),
), "employee_id", unique=(("email",),), foreign={"branch_id": ("branch", "branch_id")})
VEHICLE_TYPE = Table("vehicle_type", (
    _key("vehicle_type_id"), _text("type_name", 50, True), _text("description"),
), "vehicle_type_id")
VEHICLE = Table("vehicle", (
    _key("vehicle_id"), _text("make", 50, True), _text("model", 50, True),
    Col("production_year", INT, required=True), _text("license_plate", 20, True), _key("vehicle_type_id"),
    _key("branch_id"), Col("rental_availability", FLAG, default=True), _TOUCHED,
), "vehicle_id", unique=(("license_plate",),), foreign={
    "vehicle_type_id": ("vehicle_type", "vehicle_type_id"), "branch_id": ("branch", "branch_id"),
})
RENTAL = Table("rental_transaction", (
    _key("transaction_id"), _key("customer_id"), _key("vehicle_id"), _key("employee_id"),
    _day("rental_start_date"), _day("rental_end_date"), _TOUCHED,
), "transaction_id", foreign={
    "customer_id": ("customer", "customer_id"), "vehicle_id": ("vehicle", "vehicle_id"),
    "employee_id": ("employee", "employee_id"),
})
PAYMENT = Table("payment", (
    _key("payment_id"), _key("transaction_id"), _day("payment_date"), Col("amount", PRICE, required=True),
    _text("payment_method", 50, True),
), "payment_id", foreign={"transaction_id": ("rental_transaction", "transaction_id")})
MAINTENANCE = Table("maintenance", (
    _key("maintenance_id"), _key("vehicle_id"), _day("service_date"), _text("service_type", 100, True),
    Col("maintenance_cost", PRICE, required=True), _text("notes"),
), "maintenance_id", foreign={"vehicle_id": ("vehicle", "vehicle_id")})

OLTP = {t.name: t for t in (
    CUSTOMER, BRANCH, EMPLOYEE, VEHICLE_TYPE, VEHICLE, RENTAL, PAYMENT, MAINTENANCE,
)}


# --- star schema --------------------------------------------------------------------------------
def _dimension(name: str, source: Table) -> Table:
    """A versioned dimension: surrogate key, source id, the business columns of its source, validity."""
    business = tuple(c for c in source.columns if c.name not in (source.primary_key, "last_modified"))
    return Table(name, (_key(source.primary_key), _key("source_id"), *business, *_VERSION), source.primary_key)


DIM_CUSTOMER = _dimension("dim_customer", CUSTOMER)
DIM_BRANCH = _dimension("dim_branch", BRANCH)
DIM_EMPLOYEE = _dimension("dim_employee", EMPLOYEE)
DIM_VEHICLE_TYPE = _dimension("dim_vehicle_type", VEHICLE_TYPE)
DIM_VEHICLE = _dimension("dim_vehicle", VEHICLE)
DIM_DATE = Table("dim_date", (
    Col("date_id", INT, required=True), Col("full_date", DAY), Col("day_of_month", INT), Col("month", INT),
    Col("year", INT), Col("quarter", INT), _text("day_of_week", 15),
), "date_id", unique=(("full_date",),))
FACT_RENTAL = Table("fact_rental_transactions", (
    _key("transaction_id"), _key("customer_id"), _key("vehicle_id"), _key("employee_id"),
    Col("rental_start_date_id", INT, required=True), Col("rental_end_date_id", INT, required=True),
    Col("payment_amount", PRICE), _text("payment_method", 50), Col("source_id", ID),
), "transaction_id", unique=(
    ("customer_id", "vehicle_id", "employee_id", "rental_start_date_id", "rental_end_date_id"),
))
FACT_MAINTENANCE = Table("fact_maintenance", (
    _key("maintenance_id"), _key("vehicle_id"), Col("maintenance_date_id", INT, required=True),
    _text("service_type", 100, True), Col("maintenance_cost", PRICE, required=True), _text("notes"),
    Col("source_id", ID),
), "maintenance_id", unique=(("vehicle_id", "maintenance_date_id", "service_type"),))
ETL_CONTROL = Table("etl_control", (
    Col("etl_id", ID, required=True), _text("source_table", 50), Col("last_etl_time", STAMP), _text("status", 20),
    Col("records_processed", ID), _text("error_message"),
), "etl_id")

STAR = {t.name: t for t in (
    DIM_CUSTOMER, DIM_BRANCH, DIM_EMPLOYEE, DIM_VEHICLE_TYPE, DIM_VEHICLE, DIM_DATE, FACT_RENTAL,
    FACT_MAINTENANCE, ETL_CONTROL,
)}

# Rows a load did not take, with the reason and the row as it came.
REJECTS = Table("rejects", (
    _text("feed"), Col("seq", ID), _text("reason"), _text("raw"),
), "seq")


def _state(name: str) -> Table:
    """What the load knows of each source row of a fact: its fingerprint, and key, month and hash of its fact. ``open``: the
    row is not in the facts as it stands, since some key is missing. A log; the last run that notes a row counts."""
    return Table(name, (
        Col("source_id", ID), Col("run", ID), Col("fingerprint", ID), Col("fact_id", ID), Col("fact_month", INT),
        Col("fact_print", ID), Col("open", FLAG),
    ), "source_id")


STATE = {t.name: t for t in (_state("state_rental_transaction"), _state("state_maintenance"))}

# Rows of a source that is read by watermark, as they came, which wait for a row they refer to.
WAITING = {t.name: t for t in (
    Table("waiting_vehicle", (_key("source_id"), *(c for c in VEHICLE.columns if c.name not in ("vehicle_id", "last_modified"))), "source_id"),
)}
