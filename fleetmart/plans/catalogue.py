"""Registered queries over the given tables, each with the statement it is compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions.expressions import EPOCH, HIGH_DATE, availability, instant, money
from ..operators import asof, facts, ingest, insights, maintained, quality, rollups, scd2
from ..operators.append import insert_if_absent, upsert
from ..operators.calendar import date_rows
from ..operators.changes import apply_updates, boundary, changed_from, changed_since, watermark, watermarks
from ..operators.control import latest_runs
from ..operators.dedupe import first_rows
from ..operators.lookup import first_reason, in_turn, prepare_key
from ..operators.surrogate import number_rows
from ..session import cut_lineage, shared_dir
from ..sources.catalog import parquet_tables, register
from ..sources.csv_feed import read_feed
from ..sources.warehouse import Warehouse
from .etl import HISTORICAL, SOUND, Rules, run_etl
from .standin import FILE_ORDER, given, role, with_roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}

BATCH = datetime(2002, 1, 1)
STAMP = "yyyy-MM-dd HH:mm:ss"


def registered(statement: str | None = None, roles: str = "") -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if statement is not None:
            STATEMENTS[query.__name__] = with_roles(roles, statement) if roles else statement
        return query

    return add


def _stamp(column: str) -> Column:
    """Timestamps leave the queries as text: the open end of a version lies outside some clients' range."""
    return F.date_format(column, STAMP).alias(column)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/fleetmart/{name}-{uuid.uuid4().hex}"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A role written out, where it is expensive to derive and stands for a table that is read more than once."""
    return cut_lineage(role(spark, folder, name))


# --- rollups and reports ------------------------------------------------------------------------
@registered("""
    SELECT r.transaction_id, r.customer_id, r.vehicle_id, r.employee_id, r.rental_start_date, r.rental_end_date,
           CAST(coalesce(sum(p.amount), 0) AS DECIMAL(24,2)) AS total_cost
    FROM r_rental r LEFT JOIN r_payment p ON r.transaction_id = p.transaction_id
    GROUP BY ALL""", "r_rental r_payment")
def rental_totals(spark, folder):
    return rollups.rental_totals(role(spark, folder, "r_rental"), role(spark, folder, "r_payment"))


@registered("""
    SELECT transaction_id, CAST(sum(amount) AS DECIMAL(24,2)) AS payment_amount,
           left(string_agg(DISTINCT payment_method, ', ' ORDER BY payment_method), 50) AS payment_method
    FROM r_payment GROUP BY transaction_id""", "r_payment")
def payment_rollup(spark, folder):
    return rollups.payment_rollup(role(spark, folder, "r_payment"))


@registered("""
    , payments AS (
        SELECT l_orderkey * 8 + l_linenumber AS payment_id, l_orderkey AS transaction_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
               'method ' || l_returnflag || l_linestatus AS payment_method
        FROM lineitem
    ), kept AS (
        SELECT CASE WHEN payment_id % 11 = 3 THEN transaction_id + 1 ELSE transaction_id END AS transaction_id,
               CASE WHEN payment_id % 5 = 2 THEN amount + 1 ELSE amount END AS amount,
               CASE WHEN payment_id % 13 = 4 THEN 'corrected' ELSE payment_method END AS payment_method
        FROM payments WHERE payment_id % 7 <> 0)
    SELECT r.transaction_id, CAST(coalesce(sum(p.amount), 0) AS DECIMAL(24,2)) AS total_cost,
           left(string_agg(DISTINCT p.payment_method, ', ' ORDER BY p.payment_method), 50) AS payment_method
    FROM r_rental r LEFT JOIN kept p ON r.transaction_id = p.transaction_id
    GROUP BY r.transaction_id""", "r_rental")
def maintained_totals(spark, folder):
    """Two thirds of the payments, then the rest with corrections, then retractions: the state after three batches, each
    taken in by its changes alone, against the totals of the payments that are left."""
    method = "'method ' || l_returnflag || l_linestatus"
    amount = "CAST(l_extendedprice AS DECIMAL(10,2))"
    log = given(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS payment_id",
        f"struct(l_orderkey AS transaction_id, {amount} AS amount, {method} AS payment_method) AS first",
        f"""struct(if((l_orderkey * 8 + l_linenumber) % 11 = 3, l_orderkey + 1, l_orderkey) AS transaction_id,
                   CAST(if((l_orderkey * 8 + l_linenumber) % 5 = 2, {amount} + 1, {amount}) AS DECIMAL(10,2)) AS amount,
                   if((l_orderkey * 8 + l_linenumber) % 13 = 4, 'corrected', {method}) AS payment_method) AS then""")
    none = F.lit(None)
    batches = (
        log.filter("payment_id % 3 <> 0").select(none.alias("old"), F.col("first").alias("new")),
        log.filter("payment_id % 3 = 0 OR NOT first <=> then").select(
            F.expr("if(payment_id % 3 = 0, NULL, first)").alias("old"), F.col("then").alias("new")),
        log.filter("payment_id % 7 = 0").select(F.col("then").alias("old"), none.alias("new")))
    state = None
    for batch in batches:
        kind = log.schema["first"].dataType
        change = maintained.delta(maintained.signed(batch.select(F.col("old").cast(kind), F.col("new").cast(kind))))
        state = cut_lineage(change if state is None else maintained.merged(state, change))
    return maintained.maintained_totals(role(spark, folder, "r_rental"), state)


_TOTALS = """
    totals AS (SELECT r.transaction_id, r.vehicle_id, r.rental_start_date, r.rental_end_date,
                      coalesce(sum(p.amount), 0) AS total_cost
               FROM r_rental r LEFT JOIN r_payment p ON r.transaction_id = p.transaction_id
               GROUP BY ALL)"""


def _totals(spark, folder):
    return rollups.rental_totals(role(spark, folder, "r_rental"), role(spark, folder, "r_payment"))


@registered(f"""
    , {_TOTALS}
    SELECT v.make, v.model, v.license_plate, count(t.transaction_id) AS rental_count,
           CAST(sum(t.total_cost) AS DECIMAL(24,2)) AS total_revenue
    FROM r_vehicle v JOIN totals t ON v.vehicle_id = t.vehicle_id
    GROUP BY v.vehicle_id, v.make, v.model, v.license_plate
    ORDER BY rental_count DESC, v.vehicle_id LIMIT 5""", "r_rental r_payment r_vehicle")
def top_rented(spark, folder):
    return insights.top_rented(role(spark, folder, "r_vehicle"), _totals(spark, folder))


@registered(f"""
    , {_TOTALS},
    sums AS (SELECT vt.type_name, sum(date_diff('day', t.rental_start_date, t.rental_end_date)) AS days,
                    CAST(sum(t.total_cost) * 100 AS HUGEINT) AS cents, count(*) AS n
             FROM r_vehicle_type vt JOIN r_vehicle v ON vt.vehicle_type_id = v.vehicle_type_id
             JOIN totals t ON v.vehicle_id = t.vehicle_id GROUP BY vt.type_name)
    SELECT type_name AS vehicle_type,
           CAST(((20 * days + n) // (2 * n)) / 10.0 AS DECIMAL(18,1)) AS avg_rental_days,
           CAST(((2 * cents + n) // (2 * n)) / 100.0 AS DECIMAL(18,2)) AS avg_rental_revenue
    FROM sums ORDER BY avg_rental_revenue DESC""", "r_rental r_payment r_vehicle r_vehicle_type")
def duration_by_type(spark, folder):
    return insights.duration_by_type(
        role(spark, folder, "r_vehicle_type"), role(spark, folder, "r_vehicle"), _totals(spark, folder))


_STAR_ROLES = "r_rental r_payment r_maintenance d_customer d_vehicle d_employee"
_DATES = """
    dates AS (SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id
              FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
                    FROM (SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events)) AS lo,
                                 greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events)) AS hi)))"""
_FACT_RENTAL = f"""
    rollup AS (SELECT transaction_id, sum(amount) AS amount,
                      left(string_agg(DISTINCT payment_method, ', ' ORDER BY payment_method), 50) AS methods
               FROM r_payment GROUP BY transaction_id),
    {_DATES.strip()},
    resolved AS (
        SELECT r.transaction_id AS source_id, c.customer_id, v.vehicle_id, e.employee_id,
               s.date_id AS rental_start_date_id, t.date_id AS rental_end_date_id,
               CAST(p.amount AS DECIMAL(24,2)) AS payment_amount, p.methods AS payment_method
        FROM r_rental r LEFT JOIN rollup p ON r.transaction_id = p.transaction_id
        JOIN d_customer c ON r.customer_id = c.source_id
            AND TIMESTAMP '2002-01-01 00:00:00' BETWEEN c.valid_from AND c.valid_to
        JOIN d_vehicle v ON r.vehicle_id = v.source_id
            AND TIMESTAMP '2002-01-01 00:00:00' BETWEEN v.valid_from AND v.valid_to
        JOIN d_employee e ON r.employee_id = e.source_id
            AND TIMESTAMP '2002-01-01 00:00:00' BETWEEN e.valid_from AND e.valid_to
        JOIN dates s ON r.rental_start_date = s.full_date JOIN dates t ON r.rental_end_date = t.full_date),
    fact AS (SELECT row_number() OVER (ORDER BY source_id) AS transaction_id, * FROM resolved
             QUALIFY row_number() OVER (PARTITION BY customer_id, vehicle_id, employee_id, rental_start_date_id,
                                        rental_end_date_id ORDER BY source_id) = 1)"""
_FACT_MAINTENANCE = """
    service AS (SELECT v.vehicle_id, d.date_id AS maintenance_date_id, m.service_type, m.maintenance_cost, m.notes,
                       m.maintenance_id AS source_id
                FROM r_maintenance m JOIN d_vehicle v ON m.vehicle_id = v.source_id
                    AND TIMESTAMP '2002-01-01 00:00:00' BETWEEN v.valid_from AND v.valid_to
                JOIN dates d ON m.service_date = d.full_date
                QUALIFY row_number() OVER (PARTITION BY v.vehicle_id, d.date_id, m.service_type
                                           ORDER BY m.maintenance_id) = 1)"""


def _days(spark, folder):
    """Days from the first to the last order or event; the span is read from the tables."""
    orders = given(spark, folder, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    events = given(spark, folder, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    span = orders.unionByName(events).agg(
        F.to_date(F.min("lo")).alias("lo"), F.to_date(F.max("hi")).alias("hi"))
    return date_rows(span, "lo", "hi")


def _dim_date(spark, folder):
    return cut_lineage(_days(spark, folder))


def _fact_rental(spark, folder):
    rows = facts.resolve_rentals(
        _table(spark, folder, "r_rental"), role(spark, folder, "r_payment"), role(spark, folder, "d_customer"),
        role(spark, folder, "d_vehicle"), role(spark, folder, "d_employee"), _dim_date(spark, folder), BATCH)
    batch = facts.resolved(rows, facts.RENTAL_KEY)
    return first_rows(batch, facts.RENTAL_KEY, ["source_id"]).select(
        "source_id", *facts.RENTAL_KEY, "payment_amount", "payment_method")


def _fact_maintenance(spark, folder):
    rows = facts.resolve_maintenance(
        role(spark, folder, "r_maintenance"), role(spark, folder, "d_vehicle"), _dim_date(spark, folder), BATCH)
    batch = facts.resolved(rows, facts.MAINTENANCE_KEY)
    return first_rows(batch, facts.MAINTENANCE_KEY, ["source_id"]).select(
        *facts.MAINTENANCE_KEY, "maintenance_cost", "notes", "source_id")


@registered(f", {_FACT_RENTAL} SELECT * REPLACE (row_number() OVER (ORDER BY source_id) AS transaction_id) FROM fact",
            _STAR_ROLES)
def fact_rental(spark, folder):
    return number_rows(cut_lineage(_fact_rental(spark, folder)), "source_id", "transaction_id")


@registered(f", {_DATES}, {_FACT_MAINTENANCE} SELECT * FROM service", _STAR_ROLES)
def fact_maintenance(spark, folder):
    return _fact_maintenance(spark, folder)


@registered(f"""
    , {_FACT_RENTAL}
    SELECT CASE WHEN c.customer_id IS NULL THEN 'customer_id' WHEN v.vehicle_id IS NULL THEN 'vehicle_id'
                WHEN e.employee_id IS NULL THEN 'employee_id' WHEN s.date_id IS NULL THEN 'rental_start_date_id'
                WHEN t.date_id IS NULL THEN 'rental_end_date_id' ELSE 'resolved' END AS outcome, count(*) AS rentals
    FROM r_rental r
    LEFT JOIN d_customer c ON r.customer_id = c.source_id
        AND TIMESTAMP '2002-01-01 00:00:00' BETWEEN c.valid_from AND c.valid_to
    LEFT JOIN d_vehicle v ON r.vehicle_id = v.source_id LEFT JOIN d_employee e ON r.employee_id = e.source_id
    LEFT JOIN dates s ON r.rental_start_date = s.full_date LEFT JOIN dates t ON r.rental_end_date = t.full_date
    GROUP BY ALL""", _STAR_ROLES)
def fact_unresolved(spark, folder):
    rows = facts.resolve_rentals(
        _table(spark, folder, "r_rental"), role(spark, folder, "r_payment"), role(spark, folder, "d_customer"),
        role(spark, folder, "d_vehicle"), role(spark, folder, "d_employee"), _dim_date(spark, folder), BATCH)
    outcome = F.coalesce("unresolved", F.lit("resolved"))
    return rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rentals"))


_PROFIT = """
    SELECT v.make, v.model, v.license_plate, CAST(revenue AS DECIMAL(24,2)) AS total_revenue,
           CAST(cost AS DECIMAL(24,2)) AS total_maintenance_cost, CAST(revenue - cost AS DECIMAL(25,2)) AS net_profit
    FROM per_vehicle p JOIN d_vehicle v ON p.vehicle_id = v.vehicle_id
    WHERE revenue > 0 ORDER BY net_profit DESC, p.vehicle_id LIMIT 5"""


@registered(f"""
    , {_FACT_RENTAL}, {_FACT_MAINTENANCE},
    per_vehicle AS (SELECT f.vehicle_id, coalesce(sum(f.payment_amount), 0) AS revenue,
                           coalesce(sum(s.maintenance_cost), 0) AS cost
                    FROM fact f LEFT JOIN service s ON f.vehicle_id = s.vehicle_id GROUP BY f.vehicle_id)
    {_PROFIT}""", _STAR_ROLES)
def profit_fanout(spark, folder):
    return insights.profit_fanout(
        role(spark, folder, "d_vehicle"), _fact_rental(spark, folder), _fact_maintenance(spark, folder))


@registered(f"""
    , {_FACT_RENTAL}, {_FACT_MAINTENANCE},
    costs AS (SELECT vehicle_id, sum(maintenance_cost) AS cost FROM service GROUP BY vehicle_id),
    revenues AS (SELECT vehicle_id, coalesce(sum(payment_amount), 0) AS revenue FROM fact GROUP BY vehicle_id),
    per_vehicle AS (SELECT r.vehicle_id, r.revenue, coalesce(c.cost, 0) AS cost
                    FROM revenues r LEFT JOIN costs c ON r.vehicle_id = c.vehicle_id)
    {_PROFIT}""", _STAR_ROLES)
def profit_preagg(spark, folder):
    return insights.profit_preagg(
        role(spark, folder, "d_vehicle"), _fact_rental(spark, folder), _fact_maintenance(spark, folder))


@registered(f"""
    , {_FACT_RENTAL}
    SELECT CAST(f.rental_start_date_id // 10000 AS INTEGER) AS year,
           rpad(strftime(make_date(2000, (f.rental_start_date_id // 100) % 100, 1), '%B'), 9, ' ') AS month,
           t.type_name AS vehicle_type, CAST(sum(f.payment_amount) AS DECIMAL(24,2)) AS monthly_revenue,
           count(f.transaction_id) AS rental_count
    FROM fact f JOIN d_vehicle v ON f.vehicle_id = v.vehicle_id
    JOIN r_vehicle_type t ON v.vehicle_type_id = t.vehicle_type_id
    GROUP BY ALL""", _STAR_ROLES + " r_vehicle_type")
def monthly_revenue(spark, folder):
    fact = _fact_rental(spark, folder).withColumnRenamed("source_id", "transaction_id")
    return insights.monthly_revenue(
        fact, role(spark, folder, "d_vehicle"), role(spark, folder, "r_vehicle_type"), _dim_date(spark, folder))


@registered(f"""
    , {_TOTALS}
    SELECT v.make AS "Make", v.model AS "Model", v.license_plate AS "License Plate",
           count(t.transaction_id) AS "Rental Count", CAST(sum(t.total_cost) AS DECIMAL(24,2)) AS "Total Revenue ($)"
    FROM r_vehicle v JOIN totals t ON v.vehicle_id = t.vehicle_id
    GROUP BY v.vehicle_id, v.make, v.model, v.license_plate
    ORDER BY "Rental Count" DESC, v.vehicle_id LIMIT 5""", "r_rental r_payment r_vehicle")
def labelled_report(spark, folder):
    return insights.labelled(top_rented(spark, folder))


# --- calendar -----------------------------------------------------------------------------------
@registered(f"""
    WITH {_DATES}
    SELECT date_id, full_date, CAST(day(full_date) AS INTEGER) AS day_of_month,
           CAST(month(full_date) AS INTEGER) AS month, CAST(year(full_date) AS INTEGER) AS year,
           CAST(quarter(full_date) AS INTEGER) AS quarter, rpad(strftime(full_date, '%A'), 9, ' ') AS day_of_week
    FROM dates""")
def date_dimension(spark, folder):
    return _days(spark, folder)


# --- lookups, first row wins, idempotent append ---------------------------------------------------
@registered("""
    SELECT l_orderkey, l_partkey, l_suppkey, s.employee_id, v.vehicle_id,
           CASE WHEN s.employee_id IS NULL THEN 'unknown_employee' WHEN v.vehicle_id IS NULL THEN 'unknown_vehicle'
           END AS reject_reason
    FROM lineitem
    LEFT JOIN (SELECT email, min(employee_id) AS employee_id FROM r_employee GROUP BY email) s
        ON s.email = CASE WHEN l_linestatus = 'F' AND l_tax > 0.05 THEN 'nobody'
                          ELSE 'supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '@example.com' END
    LEFT JOIN (SELECT license_plate, min(vehicle_id) AS vehicle_id FROM r_vehicle GROUP BY license_plate) v
        ON v.license_plate = CASE WHEN l_returnflag = 'R' THEN 'p' ELSE 'P' END || CAST(l_partkey AS VARCHAR)""",
            "r_employee r_vehicle")
def key_lookup_rejects(spark, folder):
    email = F.concat(F.lit("supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), F.lit("@example.com"))
    rows = given(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.05), "nobody").otherwise(email).alias("email"),
        F.concat(F.when(F.col("l_returnflag") == "R", "p").otherwise("P"), F.col("l_partkey").cast("string")).alias(
            "plate"))
    rows = in_turn(
        rows,
        prepare_key(rows, role(spark, folder, "r_employee"), {"email": "email"}, "employee_id"),
        prepare_key(rows, role(spark, folder, "r_vehicle"), {"plate": "license_plate"}, "vehicle_id"),
    )
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "employee_id", "vehicle_id", first_reason([
        (F.col("employee_id").isNull(), "unknown_employee"), (F.col("vehicle_id").isNull(), "unknown_vehicle"),
    ]).alias("reject_reason"))


@registered("""
    SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_orderkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey, l_suppkey) = 1""")
def first_row_wins(spark, folder):
    rows = given(spark, folder, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("ship_date"), "l_orderkey", "l_suppkey")
    return first_rows(rows, ["l_partkey", "ship_date"], ["l_orderkey", "l_suppkey"])


_APPEND = """
    target AS (SELECT vehicle_id, service_type, min(maintenance_id) AS maintenance_id,
                      CAST(min(maintenance_cost) AS DECIMAL(10,2)) AS maintenance_cost
               FROM r_maintenance WHERE service_type IN ('error', 'click') GROUP BY vehicle_id, service_type),
    batch AS (SELECT vehicle_id, service_type, maintenance_id, maintenance_cost FROM r_maintenance
              QUALIFY row_number() OVER (PARTITION BY vehicle_id, service_type ORDER BY maintenance_id) = 1)"""


def _append_inputs(spark, folder):
    batch = role(spark, folder, "r_maintenance").select(
        "vehicle_id", "service_type", "maintenance_id", "maintenance_cost")
    target = batch.filter(F.col("service_type").isin("error", "click")).groupBy("vehicle_id", "service_type").agg(
        F.min("maintenance_id").alias("maintenance_id"), F.min("maintenance_cost").alias("maintenance_cost"))
    return batch, target


@registered(f"""
    , {_APPEND}
    SELECT b.* FROM batch b LEFT JOIN target t ON b.vehicle_id = t.vehicle_id AND b.service_type = t.service_type
    WHERE t.vehicle_id IS NULL""", "r_maintenance")
def insert_absent(spark, folder):
    batch, target = _append_inputs(spark, folder)
    return insert_if_absent(batch, target, ["vehicle_id", "service_type"], ["maintenance_id"])


@registered(f"""
    , {_APPEND}
    SELECT coalesce(t.vehicle_id, b.vehicle_id) AS vehicle_id, coalesce(t.service_type, b.service_type)
           AS service_type, coalesce(t.maintenance_id, b.maintenance_id) AS maintenance_id,
           coalesce(b.maintenance_cost, t.maintenance_cost) AS maintenance_cost
    FROM batch b FULL JOIN target t ON b.vehicle_id = t.vehicle_id AND b.service_type = t.service_type""",
            "r_maintenance")
def upsert_known(spark, folder):
    batch, target = _append_inputs(spark, folder)
    return upsert(target, batch, ["vehicle_id", "service_type"], ["maintenance_id"], ["maintenance_cost"])


@registered("SELECT *, row_number() OVER (ORDER BY o_orderkey) + 500 AS order_sk FROM orders")
def surrogate_keys(spark, folder):
    return number_rows(given(spark, folder, "orders"), "o_orderkey", "order_sk", start=500)


# --- loaders ------------------------------------------------------------------------------------
@registered("""
    , judged AS (
        SELECT f.*, e.email IS NOT NULL AS known, row_number() OVER (PARTITION BY f.email ORDER BY seq) AS rank
        FROM f_customer f LEFT JOIN (SELECT DISTINCT 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email
                                     FROM customer WHERE c_mktsegment = 'MACHINERY') e ON f.email = e.email)
    SELECT seq, email, 7000 + row_number() OVER (ORDER BY seq) AS customer_id,
           CASE WHEN known OR rank > 1 THEN 'duplicate_email' END AS reject_reason
    FROM judged""", "f_customer")
def load_customers(spark, folder):
    email = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    known = given(spark, folder, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.lit(7000).alias("customer_id"), email.alias("email"))
    load = ingest.load_customers(role(spark, folder, "f_customer"), known, BATCH)
    return load.judged.select("seq", "email", "customer_id", "reject_reason")


_VEHICLE_JUDGED = """
    , judged AS (
        SELECT f.*, t.vehicle_type_id, b.branch_id,
               CASE WHEN t.vehicle_type_id IS NULL THEN 'unknown_vehicle_type'
                    WHEN b.branch_id IS NULL THEN 'unknown_branch'
                    WHEN length(f.license_plate) > 20 THEN 'length:license_plate' END AS miss
        FROM f_vehicle f LEFT JOIN r_vehicle_type t ON f.vehicle_type_name = t.type_name
        LEFT JOIN r_branch b ON f.branch_name = b.name),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY license_plate, miss IS NULL ORDER BY seq) AS rank,
               sum(CASE WHEN miss IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS id
        FROM judged)"""


@registered(_VEHICLE_JUDGED + """
    SELECT seq, make, model, production_year, license_plate, vehicle_type_id, branch_id,
           coalesce(lower(rental_status_text) = 'available', FALSE) AS rental_availability,
           CASE WHEN miss IS NULL THEN CAST(id AS BIGINT) END AS vehicle_id,
           coalesce(miss, CASE WHEN rank > 1 THEN 'duplicate_license_plate' END) AS reject_reason
    FROM numbered""", "f_vehicle r_vehicle_type r_branch")
def load_vehicles(spark, folder):
    load = _vehicle_load(spark, folder)
    return load.judged.select(
        "seq", "make", "model", "production_year", "license_plate", "vehicle_type_id", "branch_id",
        "rental_availability", "vehicle_id", "reject_reason")


def _vehicle_load(spark, folder):
    return ingest.load_vehicles(
        role(spark, folder, "f_vehicle"), S.VEHICLE.empty(spark), role(spark, folder, "r_vehicle_type"),
        role(spark, folder, "r_branch"), BATCH)


@registered(_VEHICLE_JUDGED + """
    SELECT 'vehicle_feed' AS feed,
           coalesce(miss, CASE WHEN rank > 1 THEN 'duplicate_license_plate' ELSE 'accepted' END) AS outcome,
           count(*) AS rows
    FROM numbered GROUP BY ALL""", "f_vehicle r_vehicle_type r_branch")
def load_outcome(spark, folder):
    return _vehicle_load(spark, folder).outcome()


@registered(_VEHICLE_JUDGED + """
    SELECT 'vehicle_feed' AS feed, seq, coalesce(miss, 'duplicate_license_plate') AS reason, license_plate, make
    FROM numbered WHERE miss IS NOT NULL OR rank > 1""", "f_vehicle r_vehicle_type r_branch")
def reject_log(spark, folder):
    return _vehicle_load(spark, folder).rejects().select(
        "feed", "seq", "reason", *[F.get_json_object("raw", f"$.{c}").alias(c) for c in ("license_plate", "make")])


@registered("""
    SELECT row_number() OVER (ORDER BY event_id) AS seq,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(10,2)) END AS maintenance_cost,
           CASE WHEN event_type IN ('error', 'signup') THEN 'malformed'
                WHEN event_type = 'view' THEN 'length:vehicle_license_plate' END AS reject_reason
    FROM events""")
def csv_malformed_rows(spark, folder):
    """A feed in which one kind of rows has a bad number, one lacks a field and one has an over-long plate."""
    path = _scratch(spark, "services")
    kind = F.col("event_type")
    plate = F.when(kind == "view", F.lpad(F.col("user_id").cast("string"), 21, "0")).otherwise(F.col("user_id").cast("string"))
    cost = F.when(kind == "error", "none").otherwise(F.col("value").cast("decimal(10,2)").cast("string"))
    line = F.concat_ws(",", plate, F.date_format("ts", "yyyy-MM-dd"), kind, cost)
    rows = given(spark, folder, "events").orderBy("event_id").select(
        F.when(kind == "signup", line).otherwise(F.concat(line, F.lit(",x"))).alias("value"))
    rows.write.text(path)
    return read_feed(spark, path, S.MAINTENANCE_FEED, strict=False, header=False).select(
        "seq", "maintenance_cost", "reject_reason")


@registered("""
    , judged AS (
        SELECT f.*, c.customer_id, v.vehicle_id, e.employee_id,
               CASE WHEN c.customer_id IS NULL THEN 'unknown_customer'
                    WHEN v.vehicle_id IS NULL THEN 'unknown_vehicle'
                    WHEN e.employee_id IS NULL THEN 'unknown_employee' END AS miss
        FROM f_rental f
        LEFT JOIN r_customer c ON f.customer_first_name = c.first_name AND f.customer_last_name = c.last_name
        LEFT JOIN r_vehicle v ON f.vehicle_license_plate = v.license_plate
        LEFT JOIN r_employee e ON f.employee_first_name = e.first_name AND f.employee_last_name = e.last_name),
    ranked AS (
        SELECT *, coalesce(miss, CASE WHEN row_number() OVER (
            PARTITION BY vehicle_id, rental_start_date, rental_end_date, miss IS NULL ORDER BY seq) > 1
            THEN 'duplicate_rental' END) AS reject_reason FROM judged)
    SELECT seq, customer_id, vehicle_id, employee_id, rental_start_date, rental_end_date, reject_reason,
           CASE WHEN reject_reason IS NULL
                THEN CAST(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS BIGINT)
           END AS transaction_id
    FROM ranked""", "f_rental r_customer r_vehicle r_employee")
def load_rentals(spark, folder):
    load = ingest.load_rentals(
        _table(spark, folder, "f_rental"), S.RENTAL.empty(spark), role(spark, folder, "r_customer"),
        role(spark, folder, "r_vehicle"), role(spark, folder, "r_employee"), BATCH)
    return load.judged.select(
        "seq", "customer_id", "vehicle_id", "employee_id", "rental_start_date", "rental_end_date", "reject_reason",
        "transaction_id")


@registered(f"""
    , feed AS (SELECT *, row_number() OVER (ORDER BY {", ".join(FILE_ORDER)}) AS seq FROM f_payment),
    rentals AS (SELECT vehicle_id, rental_start_date, min(transaction_id) AS transaction_id
                FROM r_rental GROUP BY ALL),
    judged AS (SELECT f.*, v.vehicle_id, r.transaction_id FROM feed f
               LEFT JOIN r_vehicle v ON f.vehicle_license_plate = v.license_plate
               LEFT JOIN rentals r ON v.vehicle_id = r.vehicle_id AND f.rental_start_date = r.rental_start_date)
    SELECT seq, vehicle_id, transaction_id, payment_date, amount, payment_method,
           CASE WHEN transaction_id IS NOT NULL THEN CAST(
               sum(CASE WHEN transaction_id IS NOT NULL THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS BIGINT) END
               AS payment_id,
           CASE WHEN vehicle_id IS NULL THEN 'unknown_vehicle' WHEN transaction_id IS NULL THEN 'unknown_rental' END
               AS reject_reason
    FROM judged""", "f_payment r_vehicle r_rental")
def load_payments_csv(spark, folder):
    """The whole way of a feed: files, positional typed reading, line numbers, lookups, ids."""
    path = _scratch(spark, "payments")
    rows = role(spark, folder, "f_payment").orderBy(*FILE_ORDER).select(*S.PAYMENT_FEED.names)
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    load = ingest.load_payments(
        read_feed(spark, path, S.PAYMENT_FEED), S.PAYMENT.empty(spark), role(spark, folder, "r_rental"),
        role(spark, folder, "r_vehicle"), BATCH)
    return load.judged.select(
        "seq", "vehicle_id", "transaction_id", "payment_date", "amount", "payment_method", "payment_id",
        "reject_reason")


@registered("""
    , judged AS (
        SELECT f.*, v.vehicle_id FROM f_maintenance f LEFT JOIN r_vehicle v
            ON f.vehicle_license_plate = v.license_plate),
    ranked AS (
        SELECT *, CASE WHEN vehicle_id IS NULL THEN 'unknown_vehicle' WHEN row_number() OVER (
            PARTITION BY vehicle_id, service_date, service_type ORDER BY seq) > 1 THEN 'duplicate_maintenance' END
            AS reject_reason FROM judged)
    SELECT seq, vehicle_id, service_date, service_type, maintenance_cost, notes, reject_reason,
           CASE WHEN reject_reason IS NULL
                THEN CAST(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS BIGINT)
           END AS maintenance_id
    FROM ranked""", "f_maintenance r_vehicle")
def load_maintenance(spark, folder):
    load = ingest.load_maintenance(
        role(spark, folder, "f_maintenance"), S.MAINTENANCE.empty(spark), role(spark, folder, "r_vehicle"), BATCH)
    return load.judged.select(
        "seq", "vehicle_id", "service_date", "service_type", "maintenance_cost", "notes", "reject_reason",
        "maintenance_id")


@registered("SELECT o_orderkey, lower(o_orderstatus) = 'f' AS finished, "
            "coalesce(lower(event_type) = 'available', FALSE) AS rental_availability "
            "FROM orders LEFT JOIN (SELECT event_id, CASE WHEN event_type = 'view' THEN 'Available' "
            "WHEN event_type = 'click' THEN 'AVAILABLE' ELSE event_type END AS event_type FROM events) "
            "ON o_orderkey = event_id")
def status_flag(spark, folder):
    events = given(spark, folder, "events").select(
        F.col("event_id").alias("o_orderkey"),
        F.when(F.col("event_type") == "view", "Available").when(F.col("event_type") == "click", "AVAILABLE").otherwise(
            F.col("event_type")).alias("status"))
    return given(spark, folder, "orders").join(events, "o_orderkey", "left").select(
        "o_orderkey", (F.lower("o_orderstatus") == "f").alias("finished"),
        availability(F.col("status")).alias("rental_availability"))


# --- change extraction ----------------------------------------------------------------------------
_CONTROL = """
    control AS (SELECT event_id AS etl_id, event_type AS source_table,
                       CAST(ts AS TIMESTAMP) - INTERVAL 9490 DAY AS last_etl_time,
                       CASE WHEN value > 100 THEN 'ERROR' ELSE 'SUCCESS' END AS status, user_id AS records_processed,
                       CASE WHEN value > 100 THEN props END AS error_message
                FROM events)"""


def _control(spark, folder):
    """Events as run history: one run each, shifted into the years of the orders."""
    failed = F.col("value") > 100
    return given(spark, folder, "events").select(
        F.col("event_id").alias("etl_id"), F.col("event_type").alias("source_table"),
        (F.col("ts") - F.expr("INTERVAL 9490 DAY")).alias("last_etl_time"),
        F.when(failed, "ERROR").otherwise("SUCCESS").alias("status"), F.col("user_id").alias("records_processed"),
        F.when(failed, F.col("props")).alias("error_message"))


@registered(f"""
    WITH {_CONTROL}
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderdate > (SELECT coalesce(max(last_etl_time), TIMESTAMP '1900-01-01 00:00:00') FROM control
                         WHERE source_table = 'purchase')""")
def watermark_extract(spark, folder):
    mark = watermark(_control(spark, folder), "purchase").first()[0]
    rows = given(spark, folder, "orders")
    return changed_since(rows, mark, stamp="o_orderdate").select("o_orderkey", "o_custkey")


@registered("""
    WITH mark AS (SELECT max(o_orderdate) AS m FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderdate <= TIMESTAMP '1996-01-01 00:00:00')
    SELECT o_orderkey, CAST(2 AS INTEGER) AS run FROM orders, mark
    WHERE o_orderdate > m OR o_orderdate = m AND o_orderkey % 4 = 0
    UNION ALL
    SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderdate <= TIMESTAMP '1996-01-01 00:00:00'""")
def watermark_boundary(spark, folder):
    """A first run sees three quarters of the orders up to a date; the second takes what came later, and the orders with the
    very stamp of the boundary that only turned up since."""
    orders = given(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    seen = orders.filter("o_orderkey % 4 <> 0 AND o_orderdate <= TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    first = cut_lineage(changed_from(seen, boundary(seen.limit(0), "o_orderkey", "o_orderdate"), "o_orderkey", "o_orderdate"))
    mark = cut_lineage(boundary(first, "o_orderkey", "o_orderdate"))
    second = changed_from(orders, mark, "o_orderkey", "o_orderdate")
    return second.select("o_orderkey", F.lit(2).alias("run")).unionByName(first.select("o_orderkey", F.lit(1).alias("run")))


@registered(f"""
    WITH {_CONTROL}
    SELECT source_table, strftime(max(last_etl_time), '%Y-%m-%d %H:%M:%S') AS last_etl_time
    FROM control GROUP BY source_table""")
def control_watermarks(spark, folder):
    return watermarks(_control(spark, folder)).select("source_table", _stamp("last_etl_time"))


@registered(f"""
    WITH {_CONTROL}
    SELECT source_table, strftime(last_etl_time, '%Y-%m-%d %H:%M:%S') AS last_etl_time, status, records_processed,
           error_message, count(*) OVER (PARTITION BY source_table) AS runs
    FROM control QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY last_etl_time DESC, etl_id DESC) = 1""")
def control_latest(spark, folder):
    return latest_runs(_control(spark, folder)).select(
        "source_table", _stamp("last_etl_time"), "status", "records_processed", "error_message", "runs")


@registered("""
    SELECT c.c_custkey, CASE WHEN u.c_custkey IS NOT NULL THEN u.best ELSE c.c_mktsegment END AS c_mktsegment,
           strftime(CASE WHEN u.c_custkey IS NOT NULL THEN TIMESTAMP '2002-01-01 00:00:00'
                         ELSE TIMESTAMP '1994-01-01 00:00:00' END, '%Y-%m-%d %H:%M:%S') AS last_modified
    FROM customer c LEFT JOIN (
        SELECT o_custkey AS c_custkey, max(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS best
        FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' GROUP BY o_custkey) u
        ON c.c_custkey = u.c_custkey""")
def apply_updates_touch(spark, folder):
    base = given(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", instant("1994-01-01 00:00:00").alias("last_modified"))
    late = given(spark, folder, "orders").filter(F.col("o_orderdate") >= instant("2001-06-01 00:00:00"))
    best = F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    updates = late.groupBy(F.col("o_custkey").alias("c_custkey")).agg(best.alias("c_mktsegment"))
    return apply_updates(base, updates, "c_custkey", BATCH).select(
        "c_custkey", "c_mktsegment", _stamp("last_modified"))


# --- versioned dimensions -------------------------------------------------------------------------
# The dimension knows the customers who ordered before 1995-07 (one closed and one current version each); the source has
# all customers, those with debts under another last name, one district without a phone number.
_SCD2_INPUT = """
    dim AS (
        SELECT c.*, o.k AS k FROM r_customer c JOIN (
            SELECT o_custkey, min(o_orderdate) AS k FROM orders GROUP BY o_custkey) o ON c.customer_id = o.o_custkey
        WHERE o.k < TIMESTAMP '1995-07-01 00:00:00'),
    source AS (
        SELECT c.customer_id, c.first_name,
               CASE WHEN b.c_acctbal < 0 THEN 'CHANGED' ELSE c.last_name END AS last_name, c.email,
               CASE WHEN c.phone_number = '555-7' THEN NULL ELSE c.phone_number END AS phone_number, c.address
        FROM r_customer c JOIN customer b ON c.customer_id = b.c_custkey),
    joined AS (
        SELECT s.*, d.customer_id AS known, d.k, d.last_name AS old_last_name, d.phone_number AS old_phone,
               d.customer_id IS NOT NULL AND (d.last_name <> s.last_name
                   OR d.phone_number IS DISTINCT FROM s.phone_number) AS changed
        FROM source s LEFT JOIN dim d ON s.customer_id = d.customer_id),
    history AS (SELECT customer_id + 1000000 AS customer_id, customer_id AS source_id, 'old' AS last_name, phone_number,
                       k - INTERVAL 365 DAY AS valid_from, k - INTERVAL 1 SECOND AS valid_to, FALSE AS is_active
                FROM dim),
    existing AS (SELECT known + 2000000 AS customer_id, customer_id AS source_id, old_last_name AS last_name,
                        old_phone AS phone_number, k AS valid_from,
                        CASE WHEN changed THEN TIMESTAMP '2002-01-01 00:00:00' - INTERVAL {gap} SECOND
                             ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to, NOT changed AS is_active
                 FROM joined WHERE known IS NOT NULL),
    opened AS (SELECT (SELECT max(customer_id) FROM existing) + row_number() OVER (ORDER BY customer_id) AS customer_id,
                      customer_id AS source_id, last_name, phone_number, TIMESTAMP '2002-01-01 00:00:00' AS valid_from,
                      TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_active
               FROM joined WHERE known IS NULL {reopen})
    SELECT customer_id, source_id, last_name, phone_number, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
           strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, is_active
    FROM (SELECT * FROM history UNION ALL SELECT * FROM existing UNION ALL SELECT * FROM opened)"""


def _scd2_input(spark, folder):
    customers = role(spark, folder, "r_customer")
    orders = given(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("k"))
    known = customers.join(
        orders.filter(F.col("k") < instant("1995-07-01 00:00:00")), F.col("customer_id") == F.col("o_custkey"))

    def versions(step, last_name, start, end, active):
        return known.select(
            (F.col("customer_id") + step).alias("customer_id"), F.col("customer_id").alias("source_id"), "first_name",
            last_name.alias("last_name"), "email", "phone_number", "address", start.alias("valid_from"),
            end.alias("valid_to"), F.lit(active).alias("is_active"), start.alias("last_modified"))

    k = F.col("k")
    dim = versions(1_000_000, F.lit("old"), k - F.expr("INTERVAL 365 DAY"), k - F.expr("INTERVAL 1 SECOND"), False)
    dim = dim.unionByName(versions(2_000_000, F.col("last_name"), k, instant(HIGH_DATE), True))
    balance = given(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
    source = customers.join(balance, "customer_id").select(
        "customer_id", "first_name",
        F.when(F.col("c_acctbal") < 0, "CHANGED").otherwise(F.col("last_name")).alias("last_name"), "email",
        F.when(F.col("phone_number") != "555-7", F.col("phone_number")).alias("phone_number"), "address")
    return dim, scd2.CUSTOMER.extract(source)


def _scd2_result(spark, folder, rules):
    dim, source = _scd2_input(spark, folder)
    return scd2.scd2_merge(dim, source, scd2.CUSTOMER, BATCH, rules).select(
        "customer_id", "source_id", "last_name", "phone_number", _stamp("valid_from"), _stamp("valid_to"), "is_active")


@registered(", " + _SCD2_INPUT.format(gap=1, reopen=""), "r_customer")
def scd2_close_only(spark, folder):
    return _scd2_result(spark, folder, scd2.CLOSE_ONLY)


@registered(", " + _SCD2_INPUT.format(gap=0, reopen="OR changed"), "r_customer")
def scd2_close_and_insert(spark, folder):
    return _scd2_result(spark, folder, scd2.CLOSE_AND_INSERT)


@registered(", " + _SCD2_INPUT.format(gap=1, reopen="").replace("opened AS (", """first_run AS (""").replace("""
    SELECT customer_id, source_id, last_name, phone_number, strftime""", """,
    opened AS (
        SELECT * FROM first_run
        UNION ALL
        SELECT greatest((SELECT max(customer_id) FROM first_run), (SELECT max(customer_id) FROM existing))
                   + row_number() OVER (ORDER BY customer_id), customer_id, last_name, phone_number,
               TIMESTAMP '2002-01-02 00:00:00', TIMESTAMP '9999-12-31 00:00:00', TRUE
        FROM joined WHERE changed)
    SELECT customer_id, source_id, last_name, phone_number, strftime""", 1), "r_customer")
def scd2_close_only_next_run(spark, folder):
    """The run after a change opens the versions that the first one only closed."""
    dim, source = _scd2_input(spark, folder)
    dim = scd2.scd2_merge(dim, source, scd2.CUSTOMER, BATCH, scd2.CLOSE_ONLY)
    dim = scd2.scd2_merge(dim, source, scd2.CUSTOMER, datetime(2002, 1, 2), scd2.CLOSE_ONLY)
    return dim.select("customer_id", "source_id", "last_name", "phone_number", _stamp("valid_from"), _stamp("valid_to"),
                      "is_active")


# The other four dimensions: first load from the tables, then a changed source.
def _two_runs(spark, folder, spec: scd2.Dimension, name: str, change: dict[str, Column], show: list[str]):
    source = spec.extract(role(spark, folder, name))
    first = scd2.scd2_merge(spec.table.empty(spark), source, spec, datetime(2001, 1, 1))
    second = scd2.scd2_merge(first, source.withColumns(change), spec, BATCH)
    return second.select(spec.table.primary_key, "source_id", *show, _stamp("valid_from"), _stamp("valid_to"),
                         "is_active")


def _two_runs_sql(key: str, name: str, new: dict[str, str], changed: str, show: str) -> str:
    replaced = ", ".join(f"{expr} AS {c}" for c, expr in new.items())
    return f"""
    , first AS (SELECT {key} AS source_id, row_number() OVER (ORDER BY {key}) AS sk, * FROM {name}),
    second AS (SELECT * REPLACE ({replaced}), coalesce({changed}, FALSE) AS changed FROM first)
    SELECT sk AS {key}, source_id, {show}, '2001-01-01 00:00:00' AS valid_from,
           CASE WHEN (SELECT changed FROM second s WHERE s.source_id = first.source_id) THEN '2002-01-01 00:00:00'
                ELSE '9999-12-31 00:00:00' END AS valid_to,
           NOT (SELECT changed FROM second s WHERE s.source_id = first.source_id) AS is_active
    FROM first
    UNION ALL
    SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY source_id), source_id, {show},
           '2002-01-01 00:00:00', '9999-12-31 00:00:00', TRUE
    FROM second WHERE changed"""


@registered(_two_runs_sql(
    "vehicle_id", "r_vehicle",
    {"make": "CASE WHEN vehicle_type_id = 20557 THEN make || '+' ELSE make END",
     "rental_availability": "CASE WHEN make = 'Brand#3' THEN NULL ELSE rental_availability END"},
    "vehicle_type_id = 20557", "make, model, production_year, license_plate, vehicle_type_id, branch_id, "
    "rental_availability"), "r_vehicle")
def scd2_vehicle(spark, folder):
    """A NULL availability does not count as a change."""
    small = F.col("vehicle_type_id") == 20557
    return _two_runs(spark, folder, scd2.VEHICLE, "r_vehicle", {
        "make": F.when(small, F.concat("make", F.lit("+"))).otherwise(F.col("make")),
        "rental_availability": F.when(F.col("make") != "Brand#3", F.col("rental_availability")),
    }, scd2.VEHICLE.business)


@registered(_two_runs_sql(
    "employee_id", "r_employee", {"phone_number": "CASE WHEN branch_id < 5 THEN '555' END",
                                  "branch_id": "CASE WHEN branch_id = 9 THEN 10 ELSE branch_id END"},
    "first.branch_id < 5 OR first.branch_id = 9", "first_name, last_name, email, phone_number, branch_id"),
    "r_employee")
def scd2_employee(spark, folder):
    return _two_runs(spark, folder, scd2.EMPLOYEE, "r_employee", {
        "phone_number": F.when(F.col("branch_id") < 5, "555"),
        "branch_id": F.when(F.col("branch_id") == 9, 10).otherwise(F.col("branch_id")),
    }, scd2.EMPLOYEE.business)


@registered(_two_runs_sql(
    "branch_id", "r_branch", {"contact_number": "CASE WHEN location = 'Region 1' THEN '111' END",
                              "name": "CASE WHEN location = 'Region 2' THEN lower(name) ELSE name END"},
    "location IN ('Region 1', 'Region 2')", "name, location, contact_number"), "r_branch")
def scd2_branch(spark, folder):
    return _two_runs(spark, folder, scd2.BRANCH, "r_branch", {
        "contact_number": F.when(F.col("location") == "Region 1", "111"),
        "name": F.when(F.col("location") == "Region 2", F.lower("name")).otherwise(F.col("name")),
    }, scd2.BRANCH.business)


@registered(_two_runs_sql(
    "vehicle_type_id", "r_vehicle_type", {"description": "CASE WHEN type_name <> 'PROMO' THEN description END"},
    "type_name = 'PROMO'", "type_name, description"), "r_vehicle_type")
def scd2_vehicle_type(spark, folder):
    return _two_runs(spark, folder, scd2.VEHICLE_TYPE, "r_vehicle_type", {
        "description": F.when(F.col("type_name") != "PROMO", F.col("description")),
    }, scd2.VEHICLE_TYPE.business)


# --- as-of joins ----------------------------------------------------------------------------------
@registered("""
    SELECT r.transaction_id, r.vehicle_id AS source_vehicle, v.vehicle_id
    FROM r_rental r JOIN r_vehicle_versions v ON r.vehicle_id = v.source_id
        AND TIMESTAMP '1998-06-15 12:00:00' BETWEEN v.valid_from AND v.valid_to""", "r_rental r_vehicle_versions")
def asof_batch_join(spark, folder):
    rows = _table(spark, folder, "r_rental").select("transaction_id", F.col("vehicle_id").alias("source_vehicle"))
    versions = _table(spark, folder, "r_vehicle_versions")
    step = asof.prepare_at_batch(
        rows, versions, "source_vehicle", {"vehicle_id": "vehicle_id"}, "1998-06-15 12:00:00")
    return step(rows).dropna(subset=["vehicle_id"])


_ASOF_EVENT = """
    SELECT r.transaction_id, r.vehicle_id AS source_vehicle, r.rental_start_date, v.vehicle_id
    FROM r_rental r JOIN r_vehicle_versions v ON r.vehicle_id = v.source_id
        AND r.rental_start_date BETWEEN v.valid_from AND v.valid_to"""


def _asof_event(spark, folder, strategy):
    rows = _table(spark, folder, "r_rental").select(
        "transaction_id", F.col("vehicle_id").alias("source_vehicle"), "rental_start_date")
    step = asof.prepare_at_event(
        rows, _table(spark, folder, "r_vehicle_versions"), "source_vehicle", {"vehicle_id": "vehicle_id"},
        "rental_start_date", strategy=strategy)
    return step(rows).dropna(subset=["vehicle_id"])


@registered(_ASOF_EVENT, "r_rental r_vehicle_versions")
def asof_event_join(spark, folder):
    return _asof_event(spark, folder, "auto")


@registered(_ASOF_EVENT, "r_rental r_vehicle_versions")
def asof_event_join_large(spark, folder):
    """The way taken when the dimension is too large to broadcast."""
    return _asof_event(spark, folder, "carry")


_ASOF_EDGES = """
    , versions AS (
        SELECT p_partkey AS source_id, make_timestamp(1990 + p_size % 8, 1, 1, 0, 0, 0) AS valid_from,
               make_timestamp(1990 + p_size % 8 + n % 3, 1, 1, 0, 0, 0) AS valid_to, p_partkey * 10 + n AS vehicle_id
        FROM part CROSS JOIN (SELECT unnest([0, 1, 2, 4]) AS n)
        UNION ALL SELECT p_partkey, TIMESTAMP '1994-01-01 00:00:00', TIMESTAMP '1996-07-01 00:00:00', p_partkey * 10 + 5
        FROM part WHERE p_partkey % 2 = 0),
    points AS (SELECT DISTINCT l_partkey, l_shipdate FROM lineitem),
    started AS (
        SELECT l_partkey, l_shipdate, v.*, row_number() OVER (
            PARTITION BY l_partkey, l_shipdate ORDER BY valid_from DESC, valid_to DESC, vehicle_id DESC) AS place
        FROM points JOIN versions v ON l_partkey = source_id AND valid_from <= l_shipdate AND valid_from < valid_to)
    SELECT l_orderkey, l_linenumber, vehicle_id FROM lineitem JOIN started USING (l_partkey, l_shipdate)
    WHERE place = 1 AND l_shipdate < valid_to"""


def _asof_edges(spark, folder, strategy):
    """Versions that are empty, touch, overlap and start together; each row meets the last to start, or none."""
    year = F.lit(1990) + F.col("p_size") % 8
    part, number = given(spark, folder, "part"), F.explode(F.array(*map(F.lit, (0, 1, 2, 4)))).alias("n")
    first = part.select("p_partkey", year.alias("y"), number).select(
        F.col("p_partkey").alias("source_id"), F.expr("make_timestamp_ntz(y, 1, 1, 0, 0, 0)").alias("valid_from"),
        F.expr("make_timestamp_ntz(y + n % 3, 1, 1, 0, 0, 0)").alias("valid_to"),
        (F.col("p_partkey") * 10 + F.col("n")).alias("vehicle_id"))
    second = part.filter("p_partkey % 2 = 0").select(
        "p_partkey", F.lit("1994-01-01").cast("timestamp_ntz"), F.lit("1996-07-01").cast("timestamp_ntz"),
        F.col("p_partkey") * 10 + 5)
    rows = given(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"), "l_shipdate")
    step = asof.prepare_at_event(rows, first.union(second), "part", {"vehicle_id": "vehicle_id"}, "l_shipdate",
                                 inclusive=False, strategy=strategy)
    return step(rows).dropna(subset=["vehicle_id"]).select("l_orderkey", "l_linenumber", "vehicle_id")


@registered("WITH nothing AS (SELECT 1)" + _ASOF_EDGES)
def asof_version_edges(spark, folder):
    return _asof_edges(spark, folder, "broadcast")


@registered("WITH nothing AS (SELECT 1)" + _ASOF_EDGES)
def asof_version_edges_large(spark, folder):
    return _asof_edges(spark, folder, "carry")


# --- data quality -----------------------------------------------------------------------------------
@registered("""
    SELECT "table", rule, CAST(violations AS BIGINT) AS violations FROM (
        SELECT 'r_rental' AS "table", 'not_null:vehicle_id' AS rule, count(*) FILTER (vehicle_id IS NULL) AS violations
        FROM r_rental
        UNION ALL SELECT 'r_rental', 'not_null:customer_id', count(*) FILTER (customer_id IS NULL) FROM r_rental
        UNION ALL SELECT 'r_payment', 'length:payment_method', count(*) FILTER (length(payment_method) > 10)
        FROM r_payment
        UNION ALL SELECT 'r_payment', 'range:amount', count(*) FILTER (try_cast(amount * 1000 AS DECIMAL(10,2)) IS NULL)
        FROM r_payment
        UNION ALL SELECT 'lineitem', 'primary_key:l_orderkey,l_linenumber',
                         count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
        UNION ALL SELECT 'part', 'unique:p_name', count(*) - count(DISTINCT p_name) FROM part
        UNION ALL SELECT 'part', 'foreign_key:p_size', count(*) FILTER (p_size NOT IN (SELECT n_nationkey FROM nation))
        FROM part)""", "r_rental r_payment")
def constraint_report(spark, folder):
    rentals, payments = role(spark, folder, "r_rental"), role(spark, folder, "r_payment")
    part = given(spark, folder, "part")
    price = F.col("amount").cast("decimal(14,2)") * F.lit(1000).cast("decimal(4,0)")
    return (
        quality.row_rules(rentals, "r_rental", [
            (F.col("vehicle_id").isNull(), "not_null:vehicle_id"),
            (F.col("customer_id").isNull(), "not_null:customer_id")])
        .unionByName(quality.row_rules(payments, "r_payment", [
            (F.length("payment_method") > 10, "length:payment_method"),
            (~quality.fits_price(price), "range:amount")]))
        .unionByName(quality.unique_rule(
            given(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], "primary_key"))
        .unionByName(quality.unique_rule(part, "part", ["p_name"]))
        .unionByName(quality.foreign_rule(part, "part", "p_size", given(spark, folder, "nation"), "n_nationkey"))
    )


#: Rules over given tables, some of which they break.
_DECLARED = {
    "customer": S.Table("customer", (S.Col("c_custkey", S.ID, required=True), S.Col("c_name", S.TEXT, limit=17), S.Col("c_nationkey", S.ID)),
                        "c_custkey", unique=(("c_name",), ("c_nationkey", "c_mktsegment")), foreign={"c_nationkey": ("nation", "n_nationkey")}),
    "orders": S.Table("orders", (S.Col("o_orderkey", S.ID, required=True), S.Col("o_custkey", S.ID, required=True)), "o_orderkey",
                      unique=(("o_custkey",),), foreign={"o_custkey": ("customer", "c_custkey")}),
    "nation": S.Table("nation", (S.Col("n_nationkey", S.ID, required=True),), "n_nationkey"),
}


def _declared(spark, folder) -> dict[str, DataFrame]:
    """The given tables; a tenth of the customers is left out, so that orders lack theirs."""
    return {"customer": given(spark, folder, "customer").filter("c_custkey % 10 <> 0"), "orders": given(spark, folder, "orders"),
            "nation": given(spark, folder, "nation").filter("n_nationkey < 20")}


@registered("""
    WITH c AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0), n AS (SELECT * FROM nation WHERE n_nationkey < 20)
    SELECT "table", rule, CAST(violations AS BIGINT) AS violations FROM (
        SELECT 'customer' AS "table", 'not_null:c_custkey' AS rule, count(*) FILTER (c_custkey IS NULL) AS violations FROM c
        UNION ALL SELECT 'customer', 'length:c_name', count(*) FILTER (length(c_name) > 17) FROM c
        UNION ALL SELECT 'customer', 'primary_key:c_custkey', count(c_custkey) - count(DISTINCT c_custkey) FROM c
        UNION ALL SELECT 'customer', 'unique:c_name', count(c_name) - count(DISTINCT c_name) FROM c
        UNION ALL SELECT 'customer', 'unique:c_nationkey,c_mktsegment', coalesce(sum(k - 1), 0)
                  FROM (SELECT count(*) AS k FROM c WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment)
        UNION ALL SELECT 'customer', 'foreign_key:c_nationkey', count(c_nationkey) FILTER (c_nationkey NOT IN (SELECT n_nationkey FROM n)) FROM c
        UNION ALL SELECT 'orders', 'not_null:o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM orders
        UNION ALL SELECT 'orders', 'not_null:o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders
        UNION ALL SELECT 'orders', 'primary_key:o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'orders', 'unique:o_custkey', count(o_custkey) - count(DISTINCT o_custkey) FROM orders
        UNION ALL SELECT 'orders', 'foreign_key:o_custkey', count(o_custkey) FILTER (o_custkey NOT IN (SELECT c_custkey FROM c)) FROM orders
        UNION ALL SELECT 'nation', 'not_null:n_nationkey', count(*) FILTER (n_nationkey IS NULL) FROM n
        UNION ALL SELECT 'nation', 'primary_key:n_nationkey', count(n_nationkey) - count(DISTINCT n_nationkey) FROM n)""")
def declared_constraints(spark, folder):
    return quality.constraint_report(_declared(spark, folder), _DECLARED)


@registered("""
    WITH c AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)
    SELECT 'orders' AS "table", 'foreign_key:o_custkey' AS rule, CAST(o_custkey AS VARCHAR) AS "key", count(*) AS rows
    FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c) GROUP BY o_custkey
    UNION ALL
    SELECT 'orders', 'unique:o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders WHERE o_custkey IS NOT NULL
    GROUP BY o_custkey HAVING count(*) > 1""")
def declared_offenders(spark, folder):
    return quality.offending_keys(_declared(spark, folder), _DECLARED).filter("`table` = 'orders'")


@registered("""
    SELECT p_size AS branch_id, count(*) AS rows FROM part
    WHERE p_size NOT IN (SELECT n_nationkey FROM nation) GROUP BY p_size""")
def foreign_key_orphans(spark, folder):
    vehicles = given(spark, folder, "part").select(F.col("p_size").alias("branch_id"))
    return quality.orphans(vehicles, "branch_id", given(spark, folder, "nation"), "n_nationkey")


@registered("""
    SELECT vehicle_id, license_plate, TRUE AS rental_availability, '2002-01-01 00:00:00' AS last_modified
    FROM r_vehicle""", "r_vehicle")
def column_defaults(spark, folder):
    rows = role(spark, folder, "r_vehicle").drop("rental_availability")
    return quality.apply_defaults(rows, S.VEHICLE, BATCH).select(
        "vehicle_id", "license_plate", "rental_availability", _stamp("last_modified"))


# --- sources ----------------------------------------------------------------------------------------
@registered("""
    SELECT row_number() OVER (ORDER BY customer_id) AS seq, first_name, last_name, email,
           CASE WHEN last_name = 'MACHINERY' THEN NULL ELSE phone_number END AS phone_number,
           address || ', "' || last_name || '"' AS address
    FROM r_customer""", "r_customer")
def csv_staging(spark, folder):
    """Files with other header names, empty fields, and quoted separators and quotes."""
    path = _scratch(spark, "customers")
    rows = role(spark, folder, "r_customer").orderBy("customer_id").select(
        F.col("first_name").alias("First Name"), F.col("last_name").alias("Last Name"), F.col("email").alias("Email"),
        F.when(F.col("last_name") != "MACHINERY", F.col("phone_number")).alias("Phone Number"),
        F.concat("address", F.lit(', "'), "last_name", F.lit('"')).alias("Address"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_feed(spark, path, S.CUSTOMER_FEED).select("seq", *S.CUSTOMER_FEED.names)


@registered("""
    SELECT n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders
    FROM nation JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name""")
def source_catalog(spark, folder):
    register(parquet_tables(spark, folder, ["nation", "customer", "orders"]), "oltp_")
    return spark.sql("""
        SELECT n_name, sum(customers) AS customers, sum(orders) AS orders FROM (
            SELECT c_nationkey, count(*) AS customers, sum(coalesce(n, 0)) AS orders
            FROM oltp_customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM oltp_orders GROUP BY o_custkey)
                ON o_custkey = c_custkey
            GROUP BY c_nationkey) JOIN oltp_nation ON c_nationkey = n_nationkey
        GROUP BY n_name""")


# --- whole warehouse --------------------------------------------------------------------------------
def _oltp(spark, folder) -> dict[str, DataFrame]:
    """The roles as operational tables. Some rentals name no vehicle, some vehicles a branch that does not exist."""
    touched = instant("2001-12-01 00:00:00")
    return {
        "customer": role(spark, folder, "r_customer").withColumn("last_modified", touched),
        "branch": role(spark, folder, "r_branch"),
        "employee": role(spark, folder, "r_employee"),
        "vehicle_type": role(spark, folder, "r_vehicle_type"),
        "vehicle": role(spark, folder, "r_vehicle").withColumn("last_modified", touched),
        "rental_transaction": _table(spark, folder, "r_rental").withColumn("last_modified", touched),
        "payment": role(spark, folder, "r_payment"),
        "maintenance": role(spark, folder, "r_maintenance"),
    }


def _changed_oltp(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A later state: some customers and branches changed, payments of one kind doubled."""
    later = instant("2024-06-15 00:00:00")
    moved = F.col("last_name") == "BUILDING"
    customers = tables["customer"].withColumns({
        "address": F.when(moved, F.lit("moved")).otherwise(F.col("address")),
        "last_modified": F.when(moved, later).otherwise(F.col("last_modified")),
    })
    branches = tables["branch"].withColumn(
        "contact_number", F.when(F.col("location") == "Region 1", "111").otherwise(F.col("contact_number")))
    again = tables["payment"].filter(F.col("payment_method").startswith("method RF"))
    return tables | {"customer": customers, "branch": branches, "payment": tables["payment"].unionByName(again)}


def _runs(spark, folder, rules: Rules) -> Warehouse:
    warehouse = Warehouse(spark, _scratch(spark, "warehouse"))
    tables = _oltp(spark, folder)
    run_etl(warehouse, tables, datetime(2024, 6, 1), rules, "1995-01-01")
    run_etl(warehouse, _changed_oltp(tables), datetime(2024, 7, 1), rules, "1995-01-01")
    return warehouse


def _control_result(warehouse: Warehouse) -> DataFrame:
    return warehouse.read("etl_control").select(
        "source_table", _stamp("last_etl_time"), "status", "records_processed", "error_message")


_ETL_ROLES = "r_customer r_branch r_employee r_vehicle_type r_vehicle r_rental r_payment r_maintenance"
_ETL_SQL = """
    , rentals AS (SELECT * FROM r_rental WHERE vehicle_id IS NOT NULL),
    vehicles AS (SELECT * FROM r_vehicle WHERE branch_id IN (SELECT branch_id FROM r_branch)),
    placed AS (SELECT * FROM r_rental WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles)),
    keyed AS (SELECT DISTINCT customer_id, vehicle_id, employee_id, rental_start_date, rental_end_date FROM rentals),
    moved AS (SELECT * FROM r_customer WHERE last_name = 'BUILDING'),
    log AS (
        SELECT '2024-06-01 00:00:00' AS t, 'vehicle_type' AS s, (SELECT count(*) FROM r_vehicle_type) AS n
        UNION ALL SELECT '2024-06-01 00:00:00', 'branch', (SELECT count(*) FROM r_branch)
        UNION ALL SELECT '2024-06-01 00:00:00', 'customer', (SELECT count(*) FROM r_customer)
        UNION ALL SELECT '2024-06-01 00:00:00', 'employee', (SELECT count(*) FROM r_employee)
        UNION ALL SELECT '2024-07-01 00:00:00', 'vehicle_type', 0
        UNION ALL SELECT '2024-07-01 00:00:00', 'maintenance', 0
        {more})
    SELECT s AS source_table, t AS last_etl_time, 'SUCCESS' AS status, CAST(n AS BIGINT) AS records_processed,
           CAST(NULL AS VARCHAR) AS error_message
    FROM log"""


@registered(_ETL_SQL.format(more="""
        UNION ALL SELECT '2024-06-01 00:00:00', 'vehicle', (SELECT count(*) FROM r_vehicle)
        UNION ALL SELECT '2024-06-01 00:00:00', 'maintenance',
            (SELECT count(DISTINCT (vehicle_id, service_date, service_type)) FROM r_maintenance)
        UNION ALL SELECT '2024-06-01 00:00:00', 'rental_transaction', (SELECT count(*) FROM keyed)
        UNION ALL SELECT '2024-07-01 00:00:00', 'branch', (SELECT count(*) FROM r_branch WHERE location = 'Region 1')
        UNION ALL SELECT '2024-07-01 00:00:00', 'customer', (SELECT count(*) FROM moved)
        UNION ALL SELECT '2024-07-01 00:00:00', 'vehicle', 0
        UNION ALL SELECT '2024-07-01 00:00:00', 'employee', 0
        UNION ALL SELECT '2024-07-01 00:00:00', 'rental_transaction', 0"""), _ETL_ROLES)
def etl_runs_historical(spark, folder):
    """Two whole loads under the historical rules; the control rows tell what each changed."""
    return _control_result(_runs(spark, folder, HISTORICAL))


@registered(_ETL_SQL.format(more="""
        UNION ALL SELECT '2024-06-01 00:00:00', 'vehicle', (SELECT count(*) FROM vehicles)
        UNION ALL SELECT '2024-06-01 00:00:00', 'maintenance',
            (SELECT count(*) FROM r_maintenance WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles))
        UNION ALL SELECT '2024-06-01 00:00:00', 'rental_transaction', (SELECT count(*) FROM placed)
        UNION ALL SELECT '2024-07-01 00:00:00', 'branch', (SELECT 2 * count(*) FROM r_branch
                                                           WHERE location = 'Region 1')
        UNION ALL SELECT '2024-07-01 00:00:00', 'customer', (SELECT 2 * count(*) FROM moved)
        UNION ALL SELECT '2024-07-01 00:00:00', 'vehicle', 0
        UNION ALL SELECT '2024-07-01 00:00:00', 'employee', (SELECT 2 * count(*) FROM r_employee e JOIN r_branch b
            ON e.branch_id = b.branch_id WHERE location = 'Region 1')
        UNION ALL SELECT '2024-07-01 00:00:00', 'rental_transaction',
            (SELECT count(DISTINCT transaction_id) FROM r_payment JOIN placed USING (transaction_id)
             WHERE payment_method LIKE 'method RF%')"""), _ETL_ROLES)
def etl_runs(spark, folder):
    """Two whole loads under the sound rules."""
    return _control_result(_runs(spark, folder, SOUND))


_VEHICLES = "vehicles AS (SELECT * FROM r_vehicle WHERE branch_id IN (SELECT branch_id FROM r_branch))"


@registered(f"""
    , {_VEHICLES}
    SELECT 'vehicle' AS feed, vehicle_id AS seq, 'unknown_branch_id' AS reason,
           CAST(branch_id AS VARCHAR) AS raw_branch
    FROM r_vehicle WHERE branch_id NOT IN (SELECT branch_id FROM r_branch)
    UNION ALL SELECT 'rental_transaction', transaction_id, 'unresolved_vehicle_id', NULL FROM r_rental
    WHERE vehicle_id IS NULL OR vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)
    UNION ALL SELECT 'maintenance', maintenance_id, 'unresolved_vehicle_id', NULL FROM r_maintenance
    WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)""", _ETL_ROLES)
def etl_rejects(spark, folder):
    """What two sound loads leave out, each row once, with the reason."""
    rejects = _runs(spark, folder, SOUND).read(S.REJECTS.name)
    return rejects.select("feed", "seq", "reason", F.get_json_object("raw", "$.branch_id").alias("raw_branch"))


@registered(f"""
    , {_VEHICLES}
    SELECT 'vehicle' AS dim, v.vehicle_id AS source_id, v.make AS name, b.branch_id AS branch,
           b.location <> 'Region 1' AS branch_active, TRUE AS is_active
    FROM vehicles v JOIN r_branch b USING (branch_id)
    UNION ALL SELECT 'employee', employee_id, first_name, b.branch_id, TRUE, TRUE
    FROM r_employee e JOIN r_branch b USING (branch_id)
    UNION ALL SELECT 'employee', employee_id, first_name, b.branch_id, FALSE, FALSE
    FROM r_employee e JOIN r_branch b USING (branch_id) WHERE b.location = 'Region 1'""", _ETL_ROLES)
def etl_dimensions(spark, folder):
    """All versions of vehicles and employees after two sound loads, with the branch version they point at."""
    warehouse = _runs(spark, folder, SOUND)
    branches = warehouse.read("dim_branch").select(
        "branch_id", F.col("source_id").alias("branch"), F.col("is_active").alias("branch_active"))
    parts = [warehouse.read(f"dim_{dim}").withColumnRenamed(name, "name").join(branches, "branch_id").select(
        F.lit(dim).alias("dim"), "source_id", "name", "branch", "branch_active", "is_active")
        for dim, name in (("vehicle", "make"), ("employee", "first_name"))]
    return parts[0].unionByName(parts[1])


@registered(f"""
    , {_VEHICLES},
    moved AS (SELECT transaction_id, vehicle_id,
                     rental_start_date + CASE WHEN transaction_id % 7 = 0 THEN 45 ELSE 0 END AS s,
                     rental_end_date + CASE WHEN transaction_id % 7 IN (0, 1) THEN 60 ELSE 0 END AS e
              FROM r_rental),
    paid AS (SELECT transaction_id, sum(CASE WHEN payment_method LIKE 'method RF%' THEN 2 * amount ELSE amount END) AS a
             FROM r_payment GROUP BY transaction_id)
    SELECT 'rental' AS fact, transaction_id AS source_id, CAST(strftime(s, '%Y%m%d') AS INTEGER) AS day,
           CAST(strftime(e, '%Y%m%d') AS INTEGER) AS last_day, CAST(a AS DECIMAL(24,2)) AS amount
    FROM moved LEFT JOIN paid USING (transaction_id) WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles)
    UNION ALL SELECT 'maintenance', maintenance_id, CAST(strftime(service_date, '%Y%m%d') AS INTEGER), NULL,
           CAST(maintenance_cost + CASE WHEN maintenance_id % 5 = 0 THEN 1 ELSE 0 END AS DECIMAL(24,2))
    FROM r_maintenance WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles)""", _ETL_ROLES)
def fact_refresh(spark, folder):
    """Facts follow their source rows: moved start and end dates, late payments, a corrected cost."""
    warehouse = Warehouse(spark, _scratch(spark, "warehouse"))
    tables = _oltp(spark, folder)
    run_etl(warehouse, tables, datetime(2024, 6, 1), SOUND, "1995-01-01")
    later = _changed_oltp(tables)
    part = F.col("transaction_id") % 7
    later["rental_transaction"] = tables["rental_transaction"].withColumns({
        "rental_start_date": F.date_add("rental_start_date", F.when(part == 0, 45).otherwise(0)),
        "rental_end_date": F.date_add("rental_end_date", F.when(part < 2, 60).otherwise(0))})
    again = F.when(F.col("maintenance_id") % 5 == 0, 1).otherwise(0)
    later["maintenance"] = tables["maintenance"].withColumn(
        "maintenance_cost", (F.col("maintenance_cost") + again).cast(S.PRICE))
    run_etl(warehouse, later, datetime(2024, 7, 1), SOUND, "1995-01-01")
    rentals = warehouse.read("fact_rental_transactions").select(
        F.lit("rental").alias("fact"), "source_id", F.col("rental_start_date_id").alias("day"),
        F.col("rental_end_date_id").alias("last_day"), money(F.col("payment_amount")).alias("amount"))
    services = warehouse.read("fact_maintenance").select(
        F.lit("maintenance").alias("fact"), "source_id", F.col("maintenance_date_id").alias("day"),
        F.lit(None).cast("int").alias("last_day"), money(F.col("maintenance_cost")).alias("amount"))
    return rentals.unionByName(services)


@registered(f"""
    , {_VEHICLES},
    rentals AS (SELECT * FROM r_rental WHERE vehicle_id IN (SELECT vehicle_id FROM vehicles)),
    paid AS (SELECT transaction_id, sum(CASE WHEN payment_method LIKE 'method RF%' THEN 2 * amount ELSE amount END) AS a
             FROM r_payment GROUP BY transaction_id)
    SELECT t.type_name AS vehicle_type, CAST(year(r.rental_start_date) AS INTEGER) AS year, count(*) AS rental_count,
           CAST(sum(a) AS DECIMAL(24,2)) AS revenue, count(DISTINCT c.address) AS districts
    FROM rentals r JOIN paid USING (transaction_id) JOIN r_vehicle v USING (vehicle_id)
    JOIN r_vehicle_type t USING (vehicle_type_id) JOIN r_customer c USING (customer_id)
    GROUP BY ALL""", _ETL_ROLES)
def warehouse_report(spark, folder):
    """A report over the warehouse after two sound loads: late payments are in, and each rental counts once, with the
    customer version of its own time."""
    warehouse = _runs(spark, folder, SOUND)
    fact = warehouse.read("fact_rental_transactions")
    vehicles = warehouse.read("dim_vehicle").select("vehicle_id", "vehicle_type_id")
    types = warehouse.read("dim_vehicle_type").select("vehicle_type_id", F.col("type_name").alias("vehicle_type"))
    customers = warehouse.read("dim_customer").select("customer_id", "address")
    dates = warehouse.read("dim_date").select(F.col("date_id").alias("rental_start_date_id"), "year")
    return fact.join(dates, "rental_start_date_id").join(vehicles, "vehicle_id").join(types, "vehicle_type_id").join(
        customers, "customer_id").groupBy("vehicle_type", "year").agg(
        F.count(F.lit(1)).alias("rental_count"), money(F.sum("payment_amount")).alias("revenue"),
        F.countDistinct("address").alias("districts"))
