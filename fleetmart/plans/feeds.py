"""Operational tables on Parquet: seeding, feeds, updates, and the tables and views queries read."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators import ingest, quality
from ..operators.changes import apply_updates
from ..operators.rollups import rental_totals
from ..seeds import seed_tables
from ..session import cut_lineage, staging
from ..sources.csv_feed import read_feed
from ..sources.warehouse import Warehouse

FEEDS = {
    "customer": S.CUSTOMER_FEED, "vehicle": S.VEHICLE_FEED, "rental_transaction": S.RENTAL_FEED,
    "payment": S.PAYMENT_FEED, "maintenance": S.MAINTENANCE_FEED,
}


class Operations:
    """The operational side. Every import or update is one commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Warehouse(spark, root, S.OLTP | {S.REJECTS.name: S.REJECTS})
        self.spark = spark

    def read(self, table: str) -> DataFrame:
        return self.store.read(table)

    def tables(self) -> dict[str, DataFrame]:
        """All tables, and the view of rentals with their totals."""
        tables = {name: self.read(name) for name in S.OLTP}
        totals = rental_totals(tables["rental_transaction"], tables["payment"])
        return tables | {"rental_transaction_view": totals}

    def seed(self) -> None:
        number = self.store.last_commit() + 1
        entries = [e for name, rows in seed_tables(self.spark).items() for e in self.store.write(name, rows, number)]
        self.store.commit(entries)

    def _judge(self, table: str, feed: DataFrame, batch_ts: datetime, idempotent: bool) -> ingest.Load:
        read = self.read
        if table == "customer":
            return ingest.load_customers(feed, read(table), batch_ts)
        if table == "vehicle":
            return ingest.load_vehicles(feed, read(table), read("vehicle_type"), read("branch"), batch_ts)
        if table == "rental_transaction":
            return ingest.load_rentals(
                feed, read(table), read("customer"), read("vehicle"), read("employee"), batch_ts)
        if table == "payment":
            return ingest.load_payments(
                feed, read(table), read("rental_transaction"), read("vehicle"), batch_ts, idempotent)
        return ingest.load_maintenance(feed, read(table), read("vehicle"), batch_ts)

    def import_csv(self, table: str, path: str, batch_ts: datetime, strict: bool = True,
                   idempotent: bool = False) -> dict[str, int]:
        """Load a CSV feed into its table and return row counts by outcome.

        Lookup misses and repeats go to the reject log. A row that breaks a column constraint fails the whole import,
        unless ``strict`` is off, which sends it to the log as well.
        """
        with staging(self.spark):
            feed = read_feed(self.spark, path, FEEDS[table], strict)
            load = self._judge(table, feed, batch_ts, idempotent)
            load = ingest.Load(load.table, load.feed, cut_lineage(load.judged), batch_ts)
            if strict:
                load.require_clean()
            number = self.store.last_commit() + 1
            entries = self.store.write(table, load.accepted(), number)
            entries += self.store.write(S.REJECTS.name, load.rejects(), number)
            if entries:
                self.store.commit(entries)
            return {r["outcome"]: r["rows"] for r in load.outcome().collect()}

    def update(self, table: str, updates: DataFrame, batch_ts: datetime) -> None:
        """Set columns of the rows named in ``updates`` and stamp them. Updates that would break a declared rule of the
        table's rows or its unique keys are refused as a whole."""
        declared = S.OLTP[table]
        with staging(self.spark):
            self._update(declared, cut_lineage(updates), batch_ts)

    def _update(self, declared: S.Table, updates: DataFrame, batch_ts: datetime) -> None:
        table = declared.name
        changed = cut_lineage(apply_updates(self.read(table), updates, declared.primary_key, batch_ts))
        rules = [quality.row_rules(changed, table, quality.column_checks(declared, declared.names))]
        rules += [quality.unique_rule(changed, table, list(keys)) for keys in declared.unique]
        broken = reduce(DataFrame.unionByName, rules).filter("violations > 0").collect()
        if broken:
            raise ValueError("the updates break " + ", ".join(sorted(r["rule"] for r in broken)))
        number = self.store.last_commit() + 1
        self.store.commit(self.store.write(table, changed, number, replaces=True))
