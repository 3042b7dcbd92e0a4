"""The warehouse load: calendar, five dimensions, two facts, control rows, one commit."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schema as S
from ..functions.expressions import EPOCH
from ..operators import facts, fingerprint, scd2
from ..operators.append import append_delta
from ..operators.calendar import date_span, missing_dates
from ..operators.changes import changed_since, watermark
from ..operators.control import FAILED_RUN, control_rows, failure, success
from ..operators.lookup import BROADCAST_ROWS, any_null, first_reason, lookup_join
from ..operators.rollups import payment_rollup
from ..operators.surrogate import number_rows
from ..session import cut_lineage, staging
from ..sources.warehouse import Warehouse

CURRENT, CLOSED = "current", "closed"
CALENDAR_START = "2023-01-01"
CALENDAR_AHEAD_MONTHS = 60
#: Rows of a table in one part from which on they are written by the tasks that have them.
MANY_ROWS = 1_000_000


@dataclass(frozen=True)
class Rules:
    """What a run does where the historical behaviour and the sound one differ.

    ``versioning``: see scd2.Versioning. ``asof``: dimension version at the batch time or at the event.
    ``natural_keys``: facts are unique per source row instead of per combination of surrogates.
    ``refresh``: a fact follows every change of its source row and of its payments, also into another month.
    ``resolve``: references between dimensions hold surrogates instead of source ids. ``report``: rows a load leaves out
    for an unknown reference go to the reject log. ``inclusive``: a version is valid up to and including its valid_to.
    """

    versioning: scd2.Versioning
    asof: str
    natural_keys: bool
    refresh: bool
    resolve: bool
    inclusive: bool
    report: bool


HISTORICAL = Rules(scd2.CLOSE_ONLY, "batch", natural_keys=False, refresh=False, resolve=False, inclusive=True,
                   report=False)
SOUND = Rules(scd2.Versioning(reopen=True, gap=0, first_from=EPOCH), "event", natural_keys=True, refresh=True,
              resolve=True, inclusive=False, report=True)

# Types and branches come before the tables that refer to them; the tables of one step do not depend on each other.
DIMENSIONS = ((scd2.VEHICLE_TYPE, scd2.BRANCH), (scd2.CUSTOMER, scd2.VEHICLE, scd2.EMPLOYEE))
REFERENCES = {"vehicle_type_id": S.DIM_VEHICLE_TYPE, "branch_id": S.DIM_BRANCH}


class Run:
    """One load of the warehouse. Steps collect entries; nothing is visible before ``commit``."""

    def __init__(self, warehouse: Warehouse, sources: dict[str, DataFrame], batch_ts: datetime, rules: Rules,
                 overlap: str | None = None):
        self.wh, self.sources, self.batch_ts, self.rules, self.overlap = warehouse, sources, batch_ts, rules, overlap
        self.spark: SparkSession = warehouse.spark
        self.number = warehouse.last_commit() + 1
        self.control = warehouse.read("etl_control")
        self.entries: list[tuple] = []
        self.log: dict[str, tuple] = {}
        self.left_out: list[DataFrame] = []

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame:
        return self.wh.read(table, parts, self.entries)

    def write(self, table: str, rows: DataFrame, part: Column | None = None, replaces: bool = False,
              emptied: list[str] = (), even: bool = True) -> None:
        self.entries += self.wh.write(table, rows, self.number, part, replaces, emptied, even)

    def dates(self, start: str) -> None:
        end = F.add_months(F.lit(self.batch_ts.date()), CALENDAR_AHEAD_MONTHS)
        span = date_span(self.spark, start, end)
        self.write("dim_date", missing_dates(self.read("dim_date"), span, "start", "end"))

    def _extract(self, spec: scd2.Dimension) -> DataFrame:
        source = self.sources[spec.source.name]
        if spec.incremental:
            source = changed_since(source, watermark(self.control, spec.source.name).first()[0], self.overlap)
        rows = cut_lineage(spec.extract(source))  # a live source is read once
        if self.rules.resolve:
            waiting = f"waiting_{spec.source.name}" if spec.incremental and self.rules.report else None
            waiting = waiting if waiting in self.wh.tables else None
            held = waiting and sum(self.wh.sizes(waiting))
            if held:  # behind the watermark; a row that came again is newer
                again = self.read(waiting).join(rows.select("source_id"), "source_id", "left_anti")
                rows = rows.unionByName(again.select(*rows.columns))
            rows, unknown = self._referring(spec, rows)
            if unknown:
                rows = cut_lineage(rows.withColumn("_reason", first_reason(unknown)))
                left = rows.filter(F.col("_reason").isNotNull())
                self.leave_out(spec.source.name, left, "_reason", spec.business)
                if waiting and (held or not left.isEmpty()):
                    self.write(waiting, left, replaces=True, emptied=["all"])
                found = [F.col(f"_{c}").alias(c) if f"_{c}" in rows.columns else F.col(c) for c in ["source_id", *spec.business]]
                rows = rows.filter(F.col("_reason").isNull()).select(*found)
        return rows

    def _referring(self, spec: scd2.Dimension, rows: DataFrame) -> tuple[DataFrame, list[tuple[Column, str]]]:
        """Rows with the surrogates of their references, and a test and a reason for each reference that isn't known."""
        unknown = []
        for column in [c for c in REFERENCES if c in spec.business and c != spec.source.primary_key]:
            target = REFERENCES[column]
            lookup = self.read(target.name, [CURRENT]).select(
                F.col("source_id").alias(column), F.col(target.primary_key).alias(f"_{column}"))
            rows = lookup_join(rows, lookup, [column])
            unknown.append((F.col(column).isNotNull() & F.col(f"_{column}").isNull(), f"unknown_{column}"))
        return rows, unknown

    def leave_out(self, feed: str, rows: DataFrame, reason: str, shown: list[str]) -> None:
        """Note rows that a load does not take, with the reason and the row as it came."""
        if self.rules.report:
            self.left_out.append(rows.select(
                F.lit(feed).alias("feed"), F.col("source_id").cast("long").alias("seq"), F.col(reason).alias("reason"),
                F.to_json(F.struct(*shown)).alias("raw")))

    def rejects(self) -> None:
        """Log what was left out, once for each row and reason over all runs."""
        if self.left_out:
            found = reduce(DataFrame.unionByName, self.left_out)
            key = ["feed", "seq", "reason"]
            new = found.select(*key)
            if sum(self.wh.sizes(S.REJECTS.name)):  # the rows themselves move only if there are new ones
                new = cut_lineage(new.join(self.read(S.REJECTS.name).select(*key), key, "left_anti"))
                same = reduce(Column.__and__, [F.col(f"f.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key])
                found = found.alias("f").join(new.distinct().alias("n"), same, "left_semi")
            count = new.count()
            if count:
                self.write(S.REJECTS.name, found, even=count <= MANY_ROWS)

    def dimension(self, spec: scd2.Dimension) -> None:
        """Closed versions are only ever added; the current ones are rewritten only if some were closed."""
        table, key = spec.table.name, spec.table.primary_key
        current = self.read(table, [CURRENT])
        delta = cut_lineage(
            scd2.scd2_delta(current, self._extract(spec), spec, self.batch_ts, self.rules.versioning))
        closed, opened = scd2.delta_counts(delta)
        if closed or opened:
            versions = scd2.number_versions(delta, spec, self.wh.highest(table))
            if closed:
                gone = scd2.closed_versions(versions)
                kept = current.join(gone.select(key), key, "left_anti").select(*spec.table.names)
                self.write(table, gone, F.lit(CLOSED))
                self.write(table, kept.unionByName(scd2.current_versions(versions)), F.lit(CURRENT), replaces=True)
            else:
                self.write(table, versions, F.lit(CURRENT))
        self.log[spec.source.name] = success(spec.source.name, self.batch_ts, closed + opened)

    def _fact(self, source: str, table: str, rows: DataFrame, keys: list[str], date: str,
              pay: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None) -> None:
        """Append the facts the table lacks. Known facts whose source row or payments changed are replaced, in the month
        they lay in and in the month they move to; no other month is read again. ``pay`` adds what is paid to new facts, if the
        rows come without it; it gets their ids, too, if they are few."""
        declared = S.STAR[table]
        key, month = declared.primary_key, F.expr(f"{date} div 100")
        if self.rules.natural_keys:
            keys = ["source_id"]
        rows = cut_lineage(rows) if self.rules.report else rows  # else they are read once
        self.leave_out(source, rows.filter("unresolved IS NOT NULL").withColumn(
            "unresolved", F.concat(F.lit("unresolved_"), "unresolved")), "unresolved",
            [c for c in rows.columns if c not in ("source_id", "unresolved")])
        batch = facts.resolved(rows, list(declared.unique[0])).select(*[c for c in declared.names if c != key and c in rows.columns])
        refresh = [c for c in declared.names if c not in (key, "source_id")] if self.rules.refresh else []
        carried = {"_old_key": F.col(key), "_old_month": month}
        delta = cut_lineage(append_delta(batch, self.read(table), keys, ["source_id"], refresh, carried))
        counts = delta.groupBy("refreshes", month.alias("month"), "_old_month").count().collect()
        fresh = number_rows(
            delta.filter(~F.col("refreshes")).drop("_old_key", "_old_month"), "source_id", key, self.wh.highest(table))
        if pay:
            few = sum(r["count"] for r in counts) <= BROADCAST_ROWS
            fresh = pay(fresh, delta.select("source_id").distinct() if few else None)
        self._write_facts(table, delta, fresh, counts, keys, month)
        self.log[source] = success(source, self.batch_ts, sum(r["count"] for r in counts))
        if sum(self.wh.sizes(f"state_{source}")):  # holds no longer; built again from the facts when it is wanted
            self.entries.append((self.number, f"state_{source}", "all", True, "", 0, 0))

    def _write_facts(self, table: str, delta: DataFrame, fresh: DataFrame, counts: list, keys: list[str], month: Column) -> None:
        declared = S.STAR[table]
        months = sorted({m for r in counts if r["refreshes"] for m in (r["month"], r["_old_month"])})
        if months:
            new = delta.filter("refreshes").withColumn(declared.primary_key, F.col("_old_key")).select(*declared.names)
            old = self.read(table, [str(m) for m in months]).join(new.select(*keys), keys, "left_anti")
            added = fresh.filter(month.isin(months)).select(*declared.names)
            self.write(table, old.select(*declared.names).unionByName(new).unionByName(added), month, replaces=True,
                       emptied=[str(m) for m in months])
            fresh = fresh.filter(~month.isin(months))
        if any(not r["refreshes"] and r["month"] not in months for r in counts):
            self.write(table, fresh, month)

    def _follow(self, source: str, table: str, prints: DataFrame, resolve: Callable[[DataFrame | None], DataFrame], date: str) -> None:
        """Bring the facts of those source rows up to date that are new, changed, open or may meet a version of this run.

        ``resolve`` gives the rows whose source_id is in a table of ids, all for None. The state notes what each row looked like
        and where its fact lies, so neither the other rows nor the facts are read. Facts change as in ``_fact``.
        """
        declared, state = S.STAR[table], f"state_{source}"
        key, month = declared.primary_key, F.expr(f"{date} div 100")
        values = [c for c in declared.names if c not in (key, "source_id")]
        fact_print = F.xxhash64(*[F.col(c).cast(declared.struct[c].dataType) for c in values])
        held, added = self.wh.sizes(state)
        if held + added:
            known = fingerprint.newest(self.read(state))
        else:  # the first run, or facts from runs by other rules
            known = self.read(table).groupBy("source_id").agg(
                F.min(key).alias("fact_id"), F.min_by(month, key).alias("fact_month"), F.min_by(fact_print, key).alias("fact_print"))
            known = known.withColumns({"fingerprint": F.lit(None).cast("long"), "open": F.lit(False)})
        due = cut_lineage(fingerprint.due(prints, known, F.lit(self.batch_ts.date())))
        rows = resolve(due.select("source_id") if held + added else None)
        given = [c for c in rows.columns if c not in ("source_id", "unresolved")]
        told = due.select("source_id", "fingerprint", "known_print", F.col("fact_id").alias("_old_key"), F.col("fact_month").alias("_old_month"),
                          F.col("fact_print").alias("_old_print"), F.col("open").alias("_old_open"))
        place = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("_there"), "source_id"))
        every = rows.withColumn("_there", ~any_null(list(declared.unique[0]))).join(told, "source_id", "left")
        every = cut_lineage(every.withColumn("_place", place))  # a source row that stands twice gives one fact
        self.leave_out(source, every.filter("unresolved IS NOT NULL").withColumn(
            "unresolved", F.concat(F.lit("unresolved_"), "unresolved")), "unresolved", given)
        paired = every.filter("_place = 1 AND fingerprint IS NOT NULL").withColumns({
            "_new_month": F.when(F.col("_there"), month), "_new_print": F.when(F.col("_there"), fact_print)})
        delta = paired.filter("_there AND (_old_key IS NULL OR NOT _old_print <=> _new_print)").withColumn(
            "refreshes", F.col("_old_key").isNotNull())
        counts = delta.groupBy("refreshes", F.col("_new_month").alias("month"), "_old_month").count().collect()
        fresh = cut_lineage(number_rows(delta.filter(~F.col("refreshes")), "source_id", key, self.wh.highest(table)))
        self._write_facts(table, delta, fresh, counts, ["source_id"], month)
        noted = paired.filter("NOT _there OR _old_key IS NOT NULL").withColumn(key, F.col("_old_key")).unionByName(
            fresh.drop("refreshes")).select(
            "source_id", F.lit(self.number).cast("long").alias("run"), "fingerprint", F.col(key).alias("fact_id"),
            F.coalesce("_new_month", "_old_month").cast("int").alias("fact_month"), F.coalesce("_new_print", "_old_print").alias("fact_print"),
            (~F.col("_there")).alias("open"), "known_print", "_old_open", "_old_print")
        # rows as they were before are not noted again
        noted = cut_lineage(noted.filter(
            "NOT (fingerprint <=> known_print AND open <=> _old_open AND (open OR fact_print <=> _old_print))").select(*S.STATE[state].names))
        count = noted.count()
        if count:
            if added < held:
                self.write(state, noted, even=count <= MANY_ROWS)
            else:  # the log has grown as long as what it was added to
                log = fingerprint.newest(self.read(state).unionByName(noted)) if held + added else noted
                self.write(state, log, replaces=True, even=held + added + count <= MANY_ROWS)
        self.log[source] = success(source, self.batch_ts, sum(r["count"] for r in counts))

    @property
    def _follows(self) -> bool:
        """Whether a fact depends on its source row and the versions at its event alone, so that unchanged rows need no look."""
        return self.rules.refresh and self.rules.natural_keys and self.rules.asof == "event"

    def rentals(self) -> None:
        rules = self.rules
        rentals = cut_lineage(self.sources["rental_transaction"].select(
            "transaction_id", "customer_id", "vehicle_id", "employee_id", "rental_start_date", "rental_end_date"))
        payments = self.sources["payment"].select("transaction_id", "amount", "payment_method")
        dims = [self._versions(name) for name in ("dim_customer", "dim_vehicle", "dim_employee")]

        def pay(new: DataFrame, ids: DataFrame | None) -> DataFrame:
            """New facts with their payments; of few facts theirs alone are rolled up."""
            due = payments if ids is None else cut_lineage(_only(payments, ids, "transaction_id", bounded=True))
            return _priced(facts.with_paid(new, payment_rollup(due)))

        if not rules.refresh and not rules.report:  # no fact follows its payments and no row is logged with them
            keyed = facts.resolve_keys(rentals, *dims, self.read("dim_date"), self.batch_ts, rules.asof, rules.inclusive)
            self._fact("rental_transaction", "fact_rental_transactions", facts.unresolved(keyed, facts.RENTAL_KEY),
                       facts.RENTAL_KEY, "rental_start_date_id", pay)
            return
        paid = cut_lineage(payment_rollup(payments))  # all a fact shows of its payments

        def resolve(ids: DataFrame | None) -> DataFrame:
            theirs = payments if ids is None else payments.join(
                ids.select(F.col("source_id").alias("transaction_id")), "transaction_id", "left_semi")
            return _priced(facts.resolve_rentals(
                _only(rentals, ids, "transaction_id"), theirs, *dims, self.read("dim_date"), self.batch_ts, rules.asof,
                rules.inclusive, paid))

        if self._follows:
            prints = fingerprint.fingerprints(rentals, "transaction_id", "rental_start_date", paid, single=True)
            self._follow("rental_transaction", "fact_rental_transactions", prints, resolve, "rental_start_date_id")
        else:
            self._fact("rental_transaction", "fact_rental_transactions", resolve(None), facts.RENTAL_KEY, "rental_start_date_id")

    def maintenance(self) -> None:
        rules = self.rules
        services = cut_lineage(self.sources["maintenance"])

        def resolve(ids: DataFrame | None) -> DataFrame:
            return facts.resolve_maintenance(
                _only(services, ids, "maintenance_id"), self._versions("dim_vehicle"), self.read("dim_date"), self.batch_ts,
                rules.asof, rules.inclusive)

        if self._follows:
            prints = fingerprint.fingerprints(services, "maintenance_id", "service_date")
            self._follow("maintenance", "fact_maintenance", prints, resolve, "maintenance_date_id")
        else:
            self._fact("maintenance", "fact_maintenance", resolve(None), facts.MAINTENANCE_KEY, "maintenance_date_id")

    def _versions(self, table: str) -> DataFrame:
        """The versions a fact may meet: at the batch time only the current ones."""
        return self.read(table, [CURRENT] if self.rules.asof == "batch" else None)

    def commit(self) -> list[tuple]:
        log = [self.log[name] for name in LOGGED if name in self.log]
        rows = control_rows(self.spark, log, self.wh.highest("etl_control"))
        self.entries += self.wh.write("etl_control", rows.coalesce(1), self.number)
        self.wh.commit(self.entries)
        return log


def _priced(rows: DataFrame) -> DataFrame:
    return rows.withColumn("payment_amount", F.col("payment_amount").cast(S.PRICE))


def _only(rows: DataFrame, ids: DataFrame | None, key: str, bounded: bool = False) -> DataFrame:
    """Rows whose key is among the ids; very many rows of one key don't meet in a task."""
    if ids is None:
        return rows
    return lookup_join(rows, ids.select(F.col("source_id").alias(key), F.lit(True).alias("_due")), [key], bounded=bounded).filter("_due").drop("_due")


LOGGED = ("vehicle_type", "branch", "customer", "vehicle", "employee", "rental_transaction", "maintenance", FAILED_RUN)


def _together(*steps: Callable[[], None]) -> None:
    """Submit independent steps at once, so that small tables do not leave the cluster idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def run_etl(warehouse: Warehouse, sources: dict[str, DataFrame], batch_ts: datetime, rules: Rules = SOUND,
            calendar_start: str = CALENDAR_START, overlap: str | None = None) -> list[tuple]:
    """Load the warehouse once and return the control rows of the run. ``overlap`` (an interval such as
    ``'10 minutes'``) reads watermarked sources back behind their mark, for rows committed late.

    The whole run becomes visible at its end or not at all. On failure the error row is committed by itself, then the
    error is raised again.
    """
    run = Run(warehouse, sources, batch_ts, rules, overlap)
    try:
        with staging(warehouse.spark):
            first, second = ([partial(run.dimension, spec) for spec in step] for step in DIMENSIONS)
            _together(partial(run.dates, calendar_start), *first)
            _together(*second)
            _together(run.rentals, run.maintenance)
            run.rejects()
            return run.commit()
    except Exception as error:
        failed = Run(warehouse, sources, batch_ts, rules)
        failed.log[FAILED_RUN] = failure(batch_ts, str(error))
        failed.commit()
        raise


def reject_status(warehouse: Warehouse) -> DataFrame:
    """The reject log, each row with ``open``: whether what it names still waits. Rows of feeds that keep no record of what
    waits are open for good."""
    waiting = [warehouse.read(name).select(F.lit(name.removeprefix("waiting_")).alias("feed"), F.col("source_id").alias("seq"))
               for name in S.WAITING]
    waiting += [fingerprint.newest(warehouse.read(name)).filter("open").select(
        F.lit(name.removeprefix("state_")).alias("feed"), F.col("source_id").alias("seq")) for name in S.STATE]
    told = [name.removeprefix("waiting_").removeprefix("state_") for name in (*S.WAITING, *S.STATE)]
    still = reduce(DataFrame.unionByName, waiting).withColumn("_waits", F.lit(True))
    marked = lookup_join(warehouse.read(S.REJECTS.name), still, ["feed", "seq"])
    return marked.withColumn("open", F.coalesce("_waits", ~F.col("feed").isin(told))).drop("_waits")
