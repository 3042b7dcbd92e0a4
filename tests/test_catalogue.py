"""Every registered query against its statement, on the smallest given tables."""

import os

import pytest
from helpers import plan_of

from __spark_entry__ import entry
from check import table
from fleetmart.operators import asof, lookup, scd2
from fleetmart.plans.catalogue import QUERIES, STATEMENTS
from fleetmart.plans.standin import GIVEN

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(STATEMENTS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert table(result.collect(), result.columns) == table(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", [
    "key_lookup_rejects", "load_vehicles", "load_rentals", "load_payments_csv", "load_maintenance", "fact_rental",
    "fact_maintenance", "asof_batch_join", "scd2_close_only", "scd2_vehicle", "etl_runs", "warehouse_report",
])
def test_query_when_nothing_may_be_broadcast(spark, duck, monkeypatch, name):
    """The ways taken for tables beyond the size check."""
    for module in (lookup, asof, scd2):
        monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)
    test_query(spark, duck, name)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["top_rented", "profit_fanout", "profit_preagg"])
def test_reports_take_the_top_without_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("etl_", "warehouse_", "source_", "fact_refresh"))])
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
