"""Feeds from files to operational tables."""

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators.ingest import ConstraintViolation
from fleetmart.plans.feeds import Operations
from fleetmart.sources.catalog import Split, even_predicates, jdbc_options, jdbc_tables, register
from fleetmart.sources.csv_feed import read_feed

NOW = datetime(2024, 6, 1, 12)

CUSTOMERS = '''First,Last,Mail,Phone,Street
Ann,Lee,ann@x.com,555-1,"1 Oak St, Town"
Bob,Ray,bob@x.com,,"said ""hi"""
Ann,Lee,ann@x.com,555-9,again
Ann,Lee,ann2@x.com,555-2,namesake
'''
VEHICLES = """Make,Model,Year,Plate,Type,Branch,Status
Ford,Focus,2020,AA1,Sedan,Downtown Branch,AVAILABLE
Ford,Fiesta,2021,AA2,Hovercraft,Nowhere,Available
Ford,Kuga,2021,AA3,SUV,Nowhere,Available
Fiat,Uno,2019,AA1,SUV,Uptown Branch,Available
Fiat,Panda,2019,AA4,SUV,Uptown Branch,Rented
"""
RENTALS = """CF,CL,VM,VN,P,EF,EL,S,E
Ann,Lee,x,y,AA1,Emily,Johnson,2024-01-01,2024-01-05
Bob,Ray,x,y,AA1,Emily,Johnson,2024-01-01,2024-01-05
Zoe,Ray,x,y,ZZ9,No,Body,2024-01-01,2024-01-05
Bob,Ray,x,y,ZZ9,No,Body,2024-01-01,2024-01-05
Bob,Ray,x,y,AA4,No,Body,2024-01-01,2024-01-05
Bob,Ray,x,y,AA4,Emily,Johnson,2024-02-01,2024-02-05
"""
PAYMENTS = """Name,Plate,Start,Paid,Amount,Method
Ann Lee,AA1,2024-01-01,2024-01-01,100.00,Cash
Ann Lee,AA1,2024-01-01,2024-01-01,100.00,Cash
Ann Lee,AA1,2024-01-02,2024-01-01,100.00,Cash
Ann Lee,QQ1,2024-01-01,2024-01-01,100.00,Cash
Bob Ray,AA4,2024-02-01,2024-02-03,55.50,Debit Card
"""
SERVICES = """Plate,Day,Type,Cost,Notes
AA1,2023-01-01,Oil,10.00,first
AA1,2023-01-01,Oil,99.00,repeat
AA1,2023-01-01,Tyres,20.00,
QQ1,2023-01-01,Oil,10.00,none
"""
FILES = {"customer": CUSTOMERS, "vehicle": VEHICLES, "rental_transaction": RENTALS, "payment": PAYMENTS,
         "maintenance": SERVICES}


def save(folder, name, text):
    path = folder / f"{name}.csv"
    path.write_text(text)
    return str(path)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    ops = Operations(spark, str(folder / "oltp"))
    ops.seed()
    counts = {name: ops.import_csv(name, save(folder, name, text), NOW) for name, text in FILES.items()}
    return ops, counts, folder


def test_outcomes(loaded):
    assert loaded[1] == {
        "customer": {"accepted": 3, "duplicate_email": 1},
        "vehicle": {"accepted": 2, "unknown_vehicle_type": 1, "unknown_branch": 1, "duplicate_license_plate": 1},
        "rental_transaction": {"accepted": 2, "duplicate_rental": 1, "unknown_customer": 1, "unknown_vehicle": 1,
                               "unknown_employee": 1},
        "payment": {"accepted": 3, "unknown_rental": 1, "unknown_vehicle": 1},
        "maintenance": {"accepted": 2, "duplicate_maintenance": 1, "unknown_vehicle": 1},
    }


def test_tables(loaded):
    ops = loaded[0]
    assert rows(ops.read("customer"), "customer_id", "email", "phone_number", "address", "last_modified") == [
        (1, "ann@x.com", "555-1", "1 Oak St, Town", NOW), (2, "bob@x.com", None, 'said "hi"', NOW),
        (4, "ann2@x.com", "555-2", "namesake", NOW)]
    # The repeated plate used up number 2.
    assert rows(ops.read("vehicle"), "vehicle_id", "license_plate", "vehicle_type_id", "branch_id",
                "rental_availability") == [(1, "AA1", 1, 1, True), (3, "AA4", 2, 2, False)]
    assert rows(ops.read("rental_transaction"), "transaction_id", "customer_id", "vehicle_id", "employee_id") == [
        (1, 1, 1, 2), (2, 2, 3, 2)]
    assert rows(ops.read("payment"), "payment_id", "transaction_id", "amount") == [
        (1, 1, Decimal("100.00")), (2, 1, Decimal("100.00")), (3, 2, Decimal("55.50"))]
    assert rows(ops.read("maintenance"), "maintenance_id", "service_type", "maintenance_cost", "notes") == [
        (1, "Oil", Decimal("10.00"), "first"), (2, "Tyres", Decimal("20.00"), None)]


def test_reject_log_keeps_the_rows(loaded):
    log = loaded[0].read("rejects").filter("feed = 'vehicle_feed'").orderBy("seq").collect()
    assert [(r.seq, r.reason) for r in log] == [
        (2, "unknown_vehicle_type"), (3, "unknown_branch"), (4, "duplicate_license_plate")]
    assert json.loads(log[2].raw)["model"] == "Uno"


def test_views(spark, loaded):
    register(loaded[0].tables(), "oltp_")
    got = spark.sql("SELECT license_plate, total_cost FROM oltp_vehicle v JOIN oltp_rental_transaction_view r "
                    "ON v.vehicle_id = r.vehicle_id ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [("AA1", Decimal("200.00")), ("AA4", Decimal("55.50"))]


def test_second_load_and_update(spark, loaded, tmp_path):
    ops = Operations(spark, str(tmp_path / "oltp"))
    ops.seed()
    for _ in range(2):
        counts = {n: ops.import_csv(n, str(loaded[2] / f"{n}.csv"), NOW) for n in FILES}
    assert [counts[n].get("accepted", 0) for n in FILES] == [0, 0, 0, 3, 0]
    assert ops.read("payment").count() == 6
    again = ops.import_csv("payment", str(loaded[2] / "payment.csv"), NOW, idempotent=True)
    assert again == {"duplicate_payment": 3, "unknown_rental": 1, "unknown_vehicle": 1}
    later = datetime(2024, 7, 1)
    ops.update("customer", spark.createDataFrame([(2, "Robert")], "customer_id long, first_name string"), later)
    assert rows(ops.read("customer"), "customer_id", "first_name", "last_modified") == [
        (1, "Ann", NOW), (2, "Robert", later), (4, "Ann", NOW)]


def test_updates_keep_the_rules(spark, tmp_path):
    ops = Operations(spark, str(tmp_path / "oltp"))
    ops.import_csv("customer", save(tmp_path, "customer", CUSTOMERS), NOW)
    before = rows(ops.read("customer"))
    for bad in ([(1, None)], [(1, "x" * 51)], [(1, "a"), (1, "b")]):
        with pytest.raises(ValueError):
            ops.update("customer", spark.createDataFrame(bad, "customer_id long, first_name string"), NOW)
    assert rows(ops.read("customer")) == before


def test_empty_fields_with_and_without_quotes(spark, tmp_path):
    path = save(tmp_path, "empties", 'F,L,M,P,A\na,"",m1,,""\nb,l,m2,"",\n')
    got = rows(read_feed(spark, path, S.CUSTOMER_FEED), "seq", "last_name", "phone_number", "address")
    assert got == [(1, "", None, ""), (2, "l", "", None)]


def test_broken_constraint_fails_the_whole_load(spark, tmp_path):
    ops = Operations(spark, str(tmp_path / "oltp"))
    ops.seed()
    path = save(tmp_path, "c", CUSTOMERS + ",Nameless,n@x.com,,\n")
    with pytest.raises(ConstraintViolation, match="row 5: not_null:first_name"):
        ops.import_csv("customer", path, NOW)
    assert ops.read("customer").count() == 0 and ops.read("rejects").count() == 0
    assert ops.import_csv("customer", path, NOW, strict=False) == {
        "accepted": 3, "duplicate_email": 1, "not_null:first_name": 1}


@pytest.mark.parametrize("line", ["AA1,2023-13-01,Oil,10.00,x", "AA1,2023-01-01,Oil,ten,x", "AA1,2023-01-01,Oil",
                                  "AA1,2023-01-01,Oil,1.00,x,extra", f"{'A' * 21},2023-01-01,Oil,1.00,x"])
def test_malformed_file_fails(spark, tmp_path, line):
    path = save(tmp_path, "m", SERVICES + line + "\n")
    with pytest.raises(Exception):
        read_feed(spark, path, S.MAINTENANCE_FEED)
    kept = read_feed(spark, path, S.MAINTENANCE_FEED, strict=False)
    marked = kept.filter("reject_reason IS NOT NULL").collect()
    assert kept.count() == 5 and [r.seq for r in marked] == [5]


def test_line_numbers_follow_the_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    names = []
    for f in range(7):
        lines = [f"a,b,{f}-{i}@x.com,,{'x' * (f * 300)}" for i in range(f * 40 + 1)]
        names += [f"{f}-{i}@x.com" for i in range(f * 40 + 1)]
        (folder / f"part-{f}.csv").write_text("h,h,h,h,h\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        feed = read_feed(spark, str(folder), S.CUSTOMER_FEED)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.email for r in feed.orderBy("seq").collect()] == names
    assert [r.seq for r in feed.orderBy("seq").collect()] == list(range(1, len(names) + 1))


def test_quoted_line_breaks(spark, tmp_path):
    path = save(tmp_path, "q", 'h,h,h,h,h\na,b,c@x.com,,"two\nlines"\nd,e,f@x.com,,one\n')
    feed = read_feed(spark, path, S.CUSTOMER_FEED, multi_line=True)
    assert rows(feed, "seq", "address") == [(1, "two\nlines"), (2, "one")]


def test_remote_table_options():
    options = jdbc_options("jdbc:x:y", "public.vehicle", {"user": "u"}, Split("vehicle_id", "1", "900", 16))
    assert options["dbtable"] == "public.vehicle" and options["numPartitions"] == "16" and options["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x:y", "public.branch")


def test_large_remote_tables_need_a_split(spark):
    with pytest.raises(ValueError, match="payment"):
        jdbc_tables(spark, "jdbc:x:y", ["branch", "payment"])


SAMPLES = os.environ.get("SAMPLE_FEEDS")


@pytest.mark.skipif(not SAMPLES, reason="SAMPLE_FEEDS does not name a folder with the sample files")
def test_sample_files(spark, tmp_path):
    """Expected values were counted from the sample files by other means."""
    from fleetmart.operators import insights
    from fleetmart.plans.etl import HISTORICAL, run_etl
    from fleetmart.sources.warehouse import Warehouse

    ops = Operations(spark, str(tmp_path / "oltp"))
    ops.seed()
    names = {"customer": "customer", "vehicle": "vehicle", "rental_transaction": "transactions",
             "payment": "payments", "maintenance": "maintenance"}
    counts = {t: ops.import_csv(t, f"{SAMPLES}/{f}.csv", NOW) for t, f in names.items()}
    assert counts == {
        "customer": {"accepted": 20},
        "vehicle": {"accepted": 50, "duplicate_license_plate": 1, "unknown_branch": 1, "unknown_vehicle_type": 1},
        "rental_transaction": {"accepted": 38, "unknown_customer": 2},
        "payment": {"accepted": 77, "unknown_rental": 5},
        "maintenance": {"accepted": 50, "duplicate_maintenance": 1},
    }
    assert sorted(r.vehicle_id for r in ops.read("vehicle").collect()) == [*range(1, 50), 51]
    tables = ops.tables()
    wh = Warehouse(spark, str(tmp_path / "dwh"))
    log = run_etl(wh, tables, datetime(2024, 6, 2), HISTORICAL)
    assert [(r[0], r[3]) for r in log] == [
        ("vehicle_type", 17), ("branch", 13), ("customer", 20), ("vehicle", 50), ("employee", 26),
        ("rental_transaction", 38), ("maintenance", 50)]
    totals = tables["rental_transaction_view"]
    top = insights.top_rented(tables["vehicle"], totals)
    assert rows(top, "license_plate", "rental_count", "total_revenue") == sorted([
        ("ZX123YZ", 2, Decimal("500.00")), ("TU123VW", 2, Decimal("600.00")), ("BC789DE", 2, Decimal("600.00")),
        ("JK345LM", 2, Decimal("700.00")), ("NO678PQ", 2, Decimal("750.00"))], key=str)
    means = {r.vehicle_type: (str(r.avg_rental_days), str(r.avg_rental_revenue)) for r in insights.duration_by_type(
        tables["vehicle_type"], tables["vehicle"], totals).collect()}
    assert len(means) == 13 and means["Sedan"] == ("6.9", "342.86") and means["SUV"] == ("7.0", "335.71")
    assert means["Motorcycle"] == ("7.0", "500.00") and means["Compact Car"] == ("7.0", "250.00")
    rental, service, vehicles = (
        wh.read(t) for t in ("fact_rental_transactions", "fact_maintenance", "dim_vehicle"))

    def nets(report):
        return [(r.license_plate, int(r.net_profit)) for r in report.collect()]

    assert nets(insights.profit_fanout(vehicles, rental, service)) == [
        ("NO678PQ", 650), ("JK345LM", 600), ("NO789PQ", 475), ("TU234VW", 410), ("FG789HI", 370)]
    assert nets(insights.profit_preagg(vehicles, rental, service)) == [
        ("NO678PQ", 700), ("JK345LM", 650), ("NO789PQ", 475), ("TU123VW", 470), ("TU234VW", 410)]
    monthly = insights.monthly_revenue(rental, vehicles, wh.read("dim_vehicle_type"), wh.read("dim_date")).collect()
    assert len(monthly) == 20
    assert tuple(monthly[0]) == (2024, "January  ", "SUV", Decimal("950.00"), 3)
    assert tuple(monthly[7]) == (2024, "February ", "SUV", Decimal("2000.00"), 6)
    assert tuple(monthly[-1])[2:] == ("Luxury SUV", Decimal("400.00"), 1)
    assert {r.payment_method: r["count"] for r in rental.groupBy("payment_method").count().collect()} == {
        "Credit Card, Debit Card": 14, "Cash, Credit Card": 14, "Cash, Debit Card": 9,
        "Cash, Credit Card, Debit Card": 1}


def test_even_predicates_take_each_row_once(spark):
    """Keys that lie in one dense and one sparse stretch: strides would give one task nearly all of them."""
    keys = spark.range(10_000).select(F.when(F.col("id") % 10 > 0, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("k"))
    for parts in (1, 2, 16):
        predicates = even_predicates(keys, "k", parts)
        later = keys.union(spark.createDataFrame([(None,), (-5,), (10 ** 12,)], "k long"))
        hit = later.select(*[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(predicates)])
        sizes = hit.agg(*[F.sum(c).alias(c) for c in hit.columns]).first()
        assert len(predicates) == parts and sum(sizes) == 10_003 and max(sizes) <= 1.1 * 10_003 / parts + 3
        assert hit.filter(" + ".join(hit.columns) + " <> 1").isEmpty()
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-03-01')) AS d")
    assert even_predicates(days, "d", 2) == ["d < '2024-01-31' OR d IS NULL", "d >= '2024-01-31'"]
    assert even_predicates(days.limit(0), "d", 4) == ["1 = 1"]
    assert even_predicates(spark.range(1).select(F.lit(7).alias("k")), "k", 4) == ["k < 7 OR k IS NULL", "k >= 7"]
