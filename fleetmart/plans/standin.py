"""The given test tables in the roles of the rental business.

Each role is one portable SELECT over the given tables, so the same text defines the input of a query here and of the
statement it is compared with. ``{orders}`` and the like stand for a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

_TYPE_ID = "CAST(ascii(p_type) * 256 + ascii(substr(p_type, 2, 1)) AS BIGINT)"
_PLATE = "'P' || CAST(p_partkey AS VARCHAR(20))"

ROLES = {
    "r_customer": """
        SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
               lower(c_name) || '@example.com' AS email, '555-' || CAST(c_nationkey AS VARCHAR(10)) AS phone_number,
               'District ' || CAST(c_nationkey AS VARCHAR(10)) AS address
        FROM {customer}""",
    "r_branch": """
        SELECT CAST(n_nationkey AS BIGINT) AS branch_id, n_name AS name,
               'Region ' || CAST(n_regionkey AS VARCHAR(10)) AS location,
               CAST(NULL AS VARCHAR(15)) AS contact_number
        FROM {nation}""",
    "r_employee": """
        SELECT s_suppkey AS employee_id, s_name AS first_name, 'of ' || CAST(s_nationkey AS VARCHAR(10)) AS last_name,
               lower(s_name) || '@example.com' AS email, CAST(NULL AS VARCHAR(15)) AS phone_number,
               CAST(s_nationkey AS BIGINT) AS branch_id
        FROM {supplier}""",
    "r_vehicle_type": f"""
        SELECT {_TYPE_ID} AS vehicle_type_id, p_type AS type_name, 'Class ' || p_type AS description
        FROM {{part}} GROUP BY p_type""",
    "r_vehicle": f"""
        SELECT p_partkey AS vehicle_id, p_brand AS make, p_name AS model, 1970 + p_size AS production_year,
               {_PLATE} AS license_plate, {_TYPE_ID} AS vehicle_type_id, CAST(p_size AS BIGINT) AS branch_id,
               p_retailprice > 1000 AS rental_availability
        FROM {{part}}""",
    "r_rental": """
        SELECT o.o_orderkey AS transaction_id, o.o_custkey AS customer_id, l.vehicle_id, l.employee_id,
               CAST(o.o_orderdate AS DATE) AS rental_start_date,
               CAST(greatest(o.o_orderdate, coalesce(l.last_ship, o.o_orderdate)) AS DATE) AS rental_end_date
        FROM {orders} o LEFT JOIN (
            SELECT l_orderkey, min(l_partkey) AS vehicle_id, min(l_suppkey) AS employee_id,
                   max(l_shipdate) AS last_ship
            FROM {lineitem} GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey""",
    "r_payment": """
        SELECT l_orderkey AS transaction_id, CAST(l_shipdate AS DATE) AS payment_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
               'method ' || l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR(10)) AS payment_method
        FROM {lineitem}""",
    "r_maintenance": """
        SELECT event_id AS maintenance_id, user_id AS vehicle_id, CAST(ts AS DATE) AS service_date,
               event_type AS service_type, CAST(value AS DECIMAL(10,2)) AS maintenance_cost, props AS notes
        FROM {events}""",
    # Versions of a vehicle: one per year in which it was shipped, from its first shipping day of that year.
    "r_vehicle_versions": """
        SELECT l_partkey AS source_id, l_partkey * 10 + (y - 1995) AS vehicle_id, valid_from,
               coalesce(lead(valid_from) OVER (PARTITION BY l_partkey ORDER BY valid_from) - INTERVAL 1 SECOND,
                        TIMESTAMP '9999-12-31 00:00:00') AS valid_to
        FROM (SELECT l_partkey, CAST(extract(YEAR FROM l_shipdate) AS INTEGER) AS y, min(l_shipdate) AS valid_from
              FROM {lineitem} GROUP BY l_partkey, CAST(extract(YEAR FROM l_shipdate) AS INTEGER)) v""",
}

# Dimensions in their first version: the surrogate is the source id plus a fixed step, so a mix-up of the two shows.
STEP = 1_000_000
_OPEN = "TIMESTAMP '1990-01-01 00:00:00' AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to"
ROLES |= {
    # Customers of one segment were closed before the batch time of the queries and have no current version.
    "d_customer": f"""
        SELECT c_custkey AS source_id, c_custkey + {STEP} AS customer_id,
               TIMESTAMP '1990-01-01 00:00:00' AS valid_from,
               CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2000-12-31 23:59:59'
                    ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to
        FROM {{customer}}""",
    "d_employee": f"SELECT s_suppkey AS source_id, s_suppkey + {STEP} AS employee_id, {_OPEN} FROM {{supplier}}",
    "d_vehicle": f"""
        SELECT p_partkey AS source_id, p_partkey + {STEP} AS vehicle_id, p_brand AS make, p_name AS model,
               {_PLATE} AS license_plate, {_TYPE_ID} AS vehicle_type_id, {_OPEN}
        FROM {{part}}""",
}

# CSV-like feeds. ``seq`` is the row number in file order.
ROLES |= {
    "f_vehicle": """
        SELECT p_partkey + 1 AS seq, p_brand AS make, p_name AS model, 1970 + p_size AS production_year,
               p_brand || ' ' || p_name AS license_plate,
               CASE WHEN p_retailprice > 1050 AND p_type = 'PROMO' THEN lower(p_type) ELSE p_type END
                   AS vehicle_type_name,
               'NATION_' || CAST(p_size AS VARCHAR(10)) AS branch_name,
               CASE WHEN p_type = 'SMALL' THEN 'AVAILABLE' WHEN p_type = 'LARGE' THEN 'Available'
                    WHEN p_type = 'ECONOMY' THEN NULL ELSE 'Rented' END AS rental_status_text
        FROM {part}""",
    "f_customer": """
        SELECT o_orderkey + 1 AS seq, 'Customer ' || CAST(o_custkey AS VARCHAR(20)) AS first_name,
               o_orderstatus AS last_name, 'c' || CAST(o_custkey AS VARCHAR(20)) || '@example.com' AS email,
               substr(o_orderpriority, 1, 15) AS phone_number, CAST(NULL AS VARCHAR(10)) AS address
        FROM {orders}""",
    # Names of customers with debts are spelled in capitals, and one class of vehicles by a small plate letter.
    "f_rental": f"""
        SELECT o.o_orderkey + 1 AS seq,
               CASE WHEN c.c_acctbal < 0 THEN upper(c.c_name) ELSE c.c_name END AS customer_first_name,
               c.c_mktsegment AS customer_last_name, p.p_brand AS vehicle_make, p.p_name AS vehicle_model,
               CASE WHEN p.p_type = 'PROMO' THEN lower({_PLATE}) ELSE {_PLATE} END AS vehicle_license_plate,
               s.s_name AS employee_first_name, 'of ' || CAST(s.s_nationkey AS VARCHAR(10)) AS employee_last_name,
               CAST(date_trunc('MONTH', o.o_orderdate) AS DATE) AS rental_start_date,
               last_day(CAST(o.o_orderdate AS DATE)) AS rental_end_date
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey
                   FROM {{lineitem}} GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
        LEFT JOIN {{part}} p ON l.partkey = p.p_partkey LEFT JOIN {{supplier}} s ON l.suppkey = s.s_suppkey""",
    # Its row numbers come from reading it as files, in the order of FILE_ORDER.
    "f_payment": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax, 'Customer ' || CAST(o_custkey AS VARCHAR(20)) AS customer_name,
               'P' || CAST(l_partkey AS VARCHAR(20)) AS vehicle_license_plate, CAST(o_orderdate AS DATE) AS rental_start_date,
               CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
               'method ' || l_returnflag AS payment_method
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "f_maintenance": f"""
        SELECT event_id + 1 AS seq, CASE WHEN p_type = 'PROMO' THEN lower({_PLATE}) ELSE {_PLATE} END
               AS vehicle_license_plate, CAST(ts AS DATE) AS service_date, event_type AS service_type,
               CAST(value AS DECIMAL(10,2)) AS maintenance_cost, props AS notes
        FROM {{events}} LEFT JOIN {{part}} ON user_id = p_partkey""",
}

FILE_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "payment_date", "amount", "payment_method", "l_tax"]


def role(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A role as a DataFrame over the Parquet files of ``folder``."""
    return spark.sql(ROLES[name].format_map({t: f"parquet.`{folder}/{t}.parquet`" for t in GIVEN}))


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_roles(names: str, statement: str) -> str:
    """A statement over roles, as text over the given tables."""
    ctes = ", ".join(f"{n} AS ({ROLES[n].format_map({t: t for t in GIVEN})})" for n in names.split())
    return f"WITH {ctes} {statement}"
