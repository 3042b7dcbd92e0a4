"""The warehouse load, under the historical and under the sound rules."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators import facts
from fleetmart.operators.fingerprint import newest
from fleetmart.plans import etl
from fleetmart.plans.etl import HISTORICAL, SOUND, reject_status, run_etl
from fleetmart.sources.warehouse import Warehouse

DAY = [datetime(2024, 6, d) for d in range(1, 6)]
OLD = datetime(2024, 5, 1)


def oltp(spark):
    """Ids differ from 1..n, so that they cannot be mistaken for surrogates."""
    made = {
        "branch": [(10, "b1", "l1", None), (20, "b2", "l2", "5")],
        "vehicle_type": [(7, "Sedan", "s"), (9, "Truck", None)],
        "employee": [(31, "e", "one", "e1", None, 10), (32, "e", "two", "e2", None, 20)],
        "customer": [(51, "c", "one", "c1", None, None, OLD), (52, "c", "two", "c2", "1", "a", OLD)],
        "vehicle": [(71, "m", "n", 2020, "p1", 7, 10, True, OLD), (72, "m", "n", 2020, "p2", 9, 20, None, OLD)],
        "rental_transaction": [
            (91, 51, 71, 31, date(2024, 1, 31), date(2024, 2, 3), OLD),
            (92, 52, 72, 32, date(2024, 2, 1), date(2024, 2, 4), OLD),
            (93, 52, 71, 32, date(2022, 2, 1), date(2024, 2, 4), OLD),
            (94, 51, 71, 31, date(2024, 1, 31), date(2024, 2, 3), OLD),
        ],
        "payment": [(1, 91, date(2024, 1, 31), Decimal("100.00"), "Cash"),
                    (2, 91, date(2024, 1, 31), Decimal("20.00"), "Debit Card")],
        "maintenance": [(1, 71, date(2024, 1, 1), "Oil", Decimal("10.00"), None),
                        (2, 71, date(2024, 1, 1), "Oil", Decimal("11.00"), "again")],
    }
    return {n: spark.createDataFrame(r, S.OLTP[n].struct) for n, r in made.items()}


def changed(tables, table, key, stamp=None, **values):
    hit = F.col(S.OLTP[table].primary_key) == key
    values = {c: F.lit(v) for c, v in values.items()}
    if stamp:
        values["last_modified"] = F.lit(str(stamp)).cast("timestamp_ntz")
    columns = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}
    return tables | {table: tables[table].withColumns(columns)}


def counts(log):
    return {r[0]: r[3] for r in log}


def current(wh, dim, *columns):
    return rows(wh.read(dim).filter("is_active"), "source_id", *columns)


FIRST = {"vehicle_type": 2, "branch": 2, "customer": 2, "vehicle": 2, "employee": 2}
NONE = dict.fromkeys([*FIRST, "rental_transaction", "maintenance"], 0)


def test_historical_runs(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    assert counts(run_etl(wh, tables, DAY[0], HISTORICAL)) == FIRST | {"rental_transaction": 2, "maintenance": 1}
    fact = wh.read("fact_rental_transactions")
    assert rows(fact, "transaction_id", "customer_id", "vehicle_id", "rental_start_date_id", "payment_amount",
                "payment_method") == [
        (1, 1, 1, 20240131, Decimal("120.00"), "Cash, Debit Card"), (2, 2, 2, 20240201, None, None)]
    # References between dimensions hold source ids.
    assert rows(wh.read("dim_vehicle"), "vehicle_id", "vehicle_type_id", "branch_id") == [(1, 7, 10), (2, 9, 20)]
    assert wh.read("dim_date").count() == (date(2029, 6, 1) - date(2023, 1, 1)).days + 1
    # Same sources again: nothing moves, and a late payment does not reach the fact.
    late = tables | {"payment": tables["payment"].unionByName(
        spark.createDataFrame([(3, 92, date(2024, 3, 1), Decimal("7.00"), "Cash")], S.PAYMENT.struct))}
    assert counts(run_etl(wh, late, DAY[1], HISTORICAL)) == NONE
    assert rows(wh.read("fact_rental_transactions")) == rows(fact)
    assert wh.read("etl_control").count() == 14


@pytest.mark.parametrize("limit", [0, 200_000])
def test_a_historical_run_rolls_up_payments_of_new_facts_alone(spark, tmp_path, monkeypatch, limit):
    seen, real = [], etl.payment_rollup
    monkeypatch.setattr(etl, "payment_rollup", lambda payments: seen.append(payments.count()) or real(payments))
    monkeypatch.setattr(etl, "BROADCAST_ROWS", limit)
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0], HISTORICAL)
    more = {"rental_transaction": [(95, 52, 72, 32, date(2024, 3, 1), date(2024, 3, 4), OLD)],
            "payment": [(3, 95, date(2024, 3, 1), Decimal("7.00"), "Cash"), (4, 95, date(2024, 3, 1), Decimal("8.00"), None),
                        (5, 92, date(2024, 3, 1), Decimal("9.00"), "Cash")]}
    tables |= {n: tables[n].unionByName(spark.createDataFrame(r, S.OLTP[n].struct)) for n, r in more.items()}
    assert counts(run_etl(wh, tables, DAY[1], HISTORICAL)) == NONE | {"rental_transaction": 1}
    assert rows(wh.read("fact_rental_transactions"), "source_id", "payment_amount", "payment_method") == [
        (91, Decimal("120.00"), "Cash, Debit Card"), (92, None, None), (95, Decimal("15.00"), "Cash")]
    assert seen == ([2, 2] if limit else [2, 5])


def test_historical_change_loses_the_version_of_watermarked_tables(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0], HISTORICAL)
    tables = changed(tables, "customer", 51, DAY[0] + timedelta(hours=1), first_name="new")
    tables = changed(tables, "branch", 10, name="new")
    log = counts(run_etl(wh, tables, DAY[1], HISTORICAL))
    assert (log["customer"], log["branch"], log["rental_transaction"]) == (1, 1, 0)
    assert current(wh, "dim_customer") == [(52,)] and current(wh, "dim_branch") == [(20,)]
    closed = wh.read("dim_customer").filter("NOT is_active").first()
    assert closed.valid_to == DAY[1] - timedelta(seconds=1) and closed.first_name == "c"
    # The fully scanned branch comes back one run later, the customer only with its next change.
    log = counts(run_etl(wh, tables, DAY[2], HISTORICAL))
    assert (log["customer"], log["branch"]) == (0, 1)
    assert current(wh, "dim_branch", "name") == [(10, "new"), (20, "b2")]
    tables = changed(tables, "customer", 51, DAY[2] + timedelta(hours=1), first_name="new")
    log = counts(run_etl(wh, tables, DAY[3], HISTORICAL))
    # Under its new surrogate the rental is inserted a second time.
    assert (log["customer"], log["rental_transaction"]) == (1, 1)
    fact = wh.read("fact_rental_transactions")
    assert rows(fact.filter("source_id = 91"), "customer_id") == [(1,), (3,)]


def test_historical_fact_needs_a_current_version(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    none = tables | {"rental_transaction": tables["rental_transaction"].limit(0)}
    run_etl(wh, none, DAY[0], HISTORICAL)
    run_etl(wh, changed(none, "employee", 32, email="x"), DAY[1], HISTORICAL)
    log = counts(run_etl(wh, tables | {"employee": none["employee"].limit(0)}, DAY[2], HISTORICAL))
    assert log["rental_transaction"] == 1  # rental 92 has an employee without a current version


def test_sound_runs(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    assert counts(run_etl(wh, tables, DAY[0])) == FIRST | {"rental_transaction": 3, "maintenance": 2}
    assert rows(wh.read("dim_vehicle"), "vehicle_id", "vehicle_type_id", "branch_id") == [(1, 1, 1), (2, 2, 2)]
    # A changed customer has a new version at once; its rentals stay with the version of their time.
    tables = changed(tables, "customer", 51, DAY[0] + timedelta(hours=1), first_name="new")
    tables["payment"] = tables["payment"].unionByName(spark.createDataFrame(
        [(3, 92, date(2024, 3, 1), Decimal("7.00"), "Cash")], S.PAYMENT.struct))
    tables["rental_transaction"] = tables["rental_transaction"].unionByName(spark.createDataFrame(
        [(95, 51, 71, 31, date(2024, 6, 3), date(2024, 6, 4), DAY[1]),
         (96, 52, 71, 31, date(2024, 2, 9), date(2024, 2, 9), DAY[1])], S.RENTAL.struct))
    log = counts(run_etl(wh, tables, DAY[1]))
    assert log == NONE | {"customer": 2, "rental_transaction": 3}
    assert current(wh, "dim_customer", "first_name") == [(51, "new"), (52, "c")]
    assert rows(wh.read("fact_rental_transactions"), "source_id", "transaction_id", "customer_id", "payment_amount") == [
        (91, 1, 1, Decimal("120.00")), (92, 2, 2, Decimal("7.00")), (94, 3, 1, None), (95, 4, 3, None),
        (96, 5, 2, None)]
    assert counts(run_etl(wh, tables, DAY[2])) == NONE
    versions = wh.read("dim_customer")
    overlap = versions.alias("a").join(versions.alias("b"), "source_id").filter(
        "a.customer_id < b.customer_id AND a.valid_from < b.valid_to AND b.valid_from < a.valid_to")
    assert overlap.count() == 0


def test_facts_follow_their_source_rows(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0])
    # 92 is the only rental of February and moves to March with a late payment, 91 ends later, a cost is corrected
    tables = changed(tables, "rental_transaction", 92, rental_start_date=date(2024, 3, 1), rental_end_date=date(2024, 3, 4))
    tables = changed(tables, "rental_transaction", 91, rental_end_date=date(2024, 2, 20))
    tables = changed(tables, "maintenance", 1, maintenance_cost=Decimal("99.00"))
    tables["payment"] = tables["payment"].unionByName(spark.createDataFrame(
        [(3, 92, date(2024, 3, 1), Decimal("7.00"), "Cash")], S.PAYMENT.struct))
    log = counts(run_etl(wh, tables, DAY[1]))
    assert log == NONE | {"rental_transaction": 2, "maintenance": 1}
    fact = wh.read("fact_rental_transactions")
    assert rows(fact, "source_id", "transaction_id", "rental_start_date_id", "rental_end_date_id", "payment_amount") == [
        (91, 1, 20240131, 20240220, Decimal("120.00")), (92, 2, 20240301, 20240304, Decimal("7.00")),
        (94, 3, 20240131, 20240203, None)]
    assert wh.read("fact_rental_transactions", ["202402"]).count() == 0
    assert rows(wh.read("fact_maintenance"), "source_id", "maintenance_cost") == [(1, Decimal("99.00")), (2, Decimal("11.00"))]
    assert counts(run_etl(wh, tables, DAY[2])) == NONE
    assert wh.highest("fact_rental_transactions") == 3


def test_what_a_load_leaves_out_is_logged_once(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    tables = changed(tables, "vehicle", 72, branch_id=99)
    assert counts(run_etl(wh, tables, DAY[0])) == FIRST | {"vehicle": 1, "rental_transaction": 2, "maintenance": 2}
    expected = [("rental_transaction", 92, "unresolved_vehicle_id"), ("rental_transaction", 93, "unresolved_rental_start_date_id"),
                ("vehicle", 72, "unknown_branch_id")]
    assert rows(wh.read("rejects"), "feed", "seq", "reason") == expected
    run_etl(wh, tables, DAY[1])
    assert rows(wh.read("rejects"), "feed", "seq", "reason") == expected
    # the branch turns up, and the vehicle with it
    tables["branch"] = tables["branch"].unionByName(spark.createDataFrame([(99, "b9", "l9", None)], S.BRANCH.struct))
    tables = changed(tables, "vehicle", 72, DAY[2], make="m")
    log = counts(run_etl(wh, tables, DAY[3]))
    assert log == NONE | {"branch": 1, "vehicle": 1, "rental_transaction": 1}


def test_two_runs_at_one_batch_time(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, changed(tables, "customer", 51, DAY[0] - timedelta(hours=2), address="first"), DAY[0])
    tables = changed(tables, "customer", 51, DAY[0] + timedelta(hours=1), address="second")
    tables["rental_transaction"] = tables["rental_transaction"].unionByName(spark.createDataFrame(
        [(k, 51, 71, 31, date(2024, 7, k), date(2024, 7, k + 1), DAY[1]) for k in (1, 2, 3)], S.RENTAL.struct))
    assert counts(run_etl(wh, tables, DAY[0]))["rental_transaction"] == 3
    last = wh.read("dim_customer").filter("source_id = 51 AND is_active").first()["customer_id"]
    assert rows(wh.read("fact_rental_transactions").filter("source_id < 10"), "customer_id") == [(last,)] * 3


def test_late_commits_are_read_by_an_overlap(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0])
    late = changed(tables, "customer", 51, DAY[0] - timedelta(minutes=5), first_name="late")
    assert counts(run_etl(wh, late, DAY[1]))["customer"] == 0
    late = changed(tables, "customer", 51, DAY[1] - timedelta(minutes=5), first_name="late")
    assert counts(run_etl(wh, late, DAY[2], overlap="1 minute"))["customer"] == 0
    late = changed(tables, "customer", 51, DAY[2] - timedelta(minutes=5), first_name="late")
    assert counts(run_etl(wh, late, DAY[3], overlap="1 hour"))["customer"] == 2


def test_commits_list_live_folders_only(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    for k in range(1, 6):
        day = spark.createDataFrame([(20240100 + k, None, None, None, None, None, None)], S.DIM_DATE.struct)
        wh.commit(wh.write("dim_date", day, k, replaces=True))
    assert rows(wh.read("dim_date"), "date_id") == [(20240105,)]
    assert len([e for e in Warehouse(spark, str(tmp_path))._commits() if e[5]]) == 1
    wh.commit(wh.write("dim_date", day.limit(0), 6, replaces=True, emptied=["all"]))
    assert wh.read("dim_date").count() == 0 and wh.highest("dim_date") == 20240105 and wh.last_commit() == 6


def test_failed_run_leaves_no_trace_but_its_error_row(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0])
    before = {t: rows(wh.read(t)) for t in S.STAR if t != "etl_control"}
    broken = changed(tables, "customer", 51, DAY[1], first_name="new")
    broken["maintenance"] = broken["maintenance"].withColumn("service_type", F.raise_error(F.lit("lost source")).cast("string"))
    with pytest.raises(Exception, match="lost source"):
        run_etl(wh, broken, DAY[1])
    assert {t: rows(wh.read(t)) for t in before} == before
    error = wh.read("etl_control").filter("status = 'ERROR'").collect()
    assert [(r.source_table, r.records_processed) for r in error] == [("ETL_FULL", None)]
    assert "lost source" in error[0].error_message
    fixed = changed(tables, "customer", 51, DAY[1], first_name="new")
    assert counts(run_etl(wh, fixed, DAY[2]))["customer"] == 2


def test_empty_warehouse_reads(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "none"))
    assert wh.read("dim_customer").count() == 0 and wh.last_commit() == 0 and wh.highest("dim_customer") == 0


def test_replacing_one_part_keeps_the_others(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    dates = S.DIM_DATE

    def days(*ids):
        return spark.createDataFrame([(i, None, None, None, None, None, None) for i in ids], dates.struct)

    month = F.floor(F.col("date_id") / 100)
    wh.commit(wh.write("dim_date", days(20240101, 20240201), 1, month))
    wh.commit(wh.write("dim_date", days(20240102), 2, month))
    wh.commit(wh.write("dim_date", days(20240103), 3, month, replaces=True))
    pending = wh.write("dim_date", days(20240104, 20240202), 4, month)
    assert rows(wh.read("dim_date"), "date_id") == [(20240103,), (20240201,)]
    assert rows(wh.read("dim_date", ["202401"]), "date_id") == [(20240103,)]
    assert rows(wh.read("dim_date", pending=pending), "date_id") == [
        (20240103,), (20240104,), (20240201,), (20240202,)]
    assert wh.highest("dim_date") == 20240201


def test_a_branch_that_comes_one_run_late(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    early = tables | {"branch": tables["branch"].filter("branch_id <> 20")}
    assert counts(run_etl(wh, early, DAY[0], SOUND))["vehicle"] == 1
    assert current(wh, "dim_vehicle") == [(71,)]
    log = counts(run_etl(wh, tables, DAY[1], SOUND))  # vehicle 72 keeps its old stamp
    assert log["vehicle"] == 1 and current(wh, "dim_vehicle") == [(71,), (72,)]
    assert (92,) in rows(wh.read("fact_rental_transactions"), "source_id")
    assert counts(run_etl(wh, tables, DAY[2], SOUND)) == NONE
    assert rows(wh.read("rejects").filter("feed = 'vehicle'"), "seq", "reason") == [(72, "unknown_branch_id")]


def test_a_move_to_a_branch_that_comes_late(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0], SOUND)
    tables = changed(tables, "vehicle", 72, DAY[0] + timedelta(hours=1), branch_id=30)
    assert counts(run_etl(wh, tables, DAY[1], SOUND))["vehicle"] == 0
    tables["branch"] = tables["branch"].unionByName(spark.createDataFrame([(30, "b3", "l3", None)], S.OLTP["branch"].struct))
    assert counts(run_etl(wh, tables, DAY[2], SOUND))["vehicle"] == 2
    assert counts(run_etl(wh, tables, DAY[3], SOUND)) == NONE


@pytest.fixture
def resolved_counts(monkeypatch):
    """Rentals and payments that each run resolves."""
    seen, real = [], facts.resolve_rentals

    def counted(rentals, payments, *others):
        seen.append((rentals.count(), payments.count()))
        return real(rentals, payments, *others)

    monkeypatch.setattr(facts, "resolve_rentals", counted)
    return seen


def test_a_run_resolves_what_changed_alone(spark, tmp_path, resolved_counts):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    for day in DAY[:2]:  # 93 lies before the calendar and is tried again
        run_etl(wh, tables, day)
    pay = lambda *p: tables["payment"].unionByName(spark.createDataFrame([p], S.PAYMENT.struct))
    tables["payment"] = pay(3, 92, date(2024, 3, 1), Decimal("7.00"), "Cash")
    assert counts(run_etl(wh, tables, DAY[2])) == NONE | {"rental_transaction": 1}
    # two payments swap their methods: number and sum stay
    tables = changed(tables, "payment", 1, payment_method="Debit Card")
    assert counts(run_etl(wh, tables, DAY[3])) == NONE | {"rental_transaction": 1}
    assert resolved_counts == [(4, 2), (1, 0), (2, 1), (2, 2)]
    assert rows(wh.read("fact_rental_transactions"), "source_id", "payment_amount", "payment_method") == [
        (91, Decimal("120.00"), "Debit Card"), (92, Decimal("7.00"), "Cash"), (94, None, None)]
    state = newest(wh.read("state_rental_transaction"))
    assert rows(state, "source_id", "fact_id", "fact_month", "open") == [(91, 1, 202401, False), (92, 2, 202402, False), (93, None, None, True), (94, 3, 202401, False)]


def test_facts_without_a_state_are_taken_over(spark, tmp_path, resolved_counts):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0])
    wh.commit([(wh.last_commit() + 1, "state_rental_transaction", "all", True, "", 0, 0)])
    assert counts(run_etl(wh, tables, DAY[1])) == NONE
    assert counts(run_etl(wh, tables, DAY[2])) == NONE
    assert resolved_counts == [(4, 2), (4, 2), (1, 0)]
    assert wh.read("fact_rental_transactions").count() == 3


def test_rentals_to_come_meet_later_versions(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    tables = changed(tables, "rental_transaction", 94, rental_start_date=date(2024, 7, 1), rental_end_date=date(2024, 7, 2))
    run_etl(wh, tables, DAY[0])
    tables = changed(tables, "customer", 51, DAY[0] + timedelta(hours=1), first_name="new")
    assert counts(run_etl(wh, tables, DAY[1])) == NONE | {"customer": 2, "rental_transaction": 1}
    last = wh.read("dim_customer").filter("source_id = 51 AND is_active").first()["customer_id"]
    assert rows(wh.read("fact_rental_transactions").filter("customer_id > 2"), "source_id", "customer_id") == [(94, last)]


def test_waiting_rows_close_when_what_they_wait_for_comes(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    tables = changed(tables, "vehicle", 72, branch_id=99)
    run_etl(wh, tables, DAY[0])
    assert rows(wh.read("waiting_vehicle"), "source_id", "branch_id") == [(72, 99)]
    status = [("rental_transaction", 92, True), ("rental_transaction", 93, True), ("vehicle", 72, True)]
    assert rows(reject_status(wh), "feed", "seq", "open") == status
    late = tables | {"branch": tables["branch"].unionByName(spark.createDataFrame([(99, "b9", "l9", None)], S.BRANCH.struct))}
    # the vehicle itself is not read again: it lies behind the watermark, and is gone from the source by now
    late["vehicle"] = late["vehicle"].filter("vehicle_id <> 72")
    assert counts(run_etl(wh, late, DAY[1])) == NONE | {"branch": 1, "vehicle": 1, "rental_transaction": 1}
    assert wh.read("waiting_vehicle").isEmpty()
    assert rows(reject_status(wh), "feed", "seq", "open") == [("rental_transaction", 92, False), ("rental_transaction", 93, True), ("vehicle", 72, False)]


def test_state_log_is_merged_when_it_has_grown(spark, tmp_path):
    wh, tables = Warehouse(spark, str(tmp_path)), oltp(spark)
    run_etl(wh, tables, DAY[0])
    assert wh.sizes("state_rental_transaction") == (4, 0)
    seen = []
    for k in range(1, 4):
        tables = changed(tables, "rental_transaction", 91, rental_end_date=date(2024, 3, k))
        tables = changed(tables, "rental_transaction", 92, rental_end_date=date(2024, 3, k))
        run_etl(wh, tables, DAY[k])
        seen.append(wh.sizes("state_rental_transaction"))
    assert seen == [(4, 2), (4, 4), (4, 0)]


def test_empty_and_many_part_writes_are_counted(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    days = spark.createDataFrame([(20240100 + k, None, k, None, None, None, None) for k in range(1, 7)], S.DIM_DATE.struct)
    assert wh.write("dim_date", days.limit(0), 1) == []
    assert [e[5:] for e in wh.write("dim_date", days, 2)] == [(6, 20240106)]
    assert [(e[2], *e[5:]) for e in wh.write("dim_date", days, 3, F.col("day_of_month") % 2)] == [("0", 3, 20240106), ("1", 3, 20240105)]
