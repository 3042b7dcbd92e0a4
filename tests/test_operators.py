import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators import asof, changes, insights, maintained, quality, rollups
from fleetmart.operators.append import append_delta, insert_if_absent, upsert
from fleetmart.operators.asof import prepare_at_batch, prepare_at_event
from fleetmart.operators.changes import apply_updates, changed_since, watermark
from fleetmart.operators.control import control_rows, failure, latest_runs, success
from fleetmart.operators.dedupe import first_rows, mark_winners
from fleetmart.operators import lookup as lookups
from fleetmart.operators.lookup import fits_broadcast, lookup_join, natural_key
from fleetmart.operators.surrogate import WIDTH, number_rows


# --- lookups --------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows on one key, a tenth without a key, some keys unknown to the lookup."""
    pick = random.Random(1)
    keys = [7 if i % 3 == 0 else None if i % 10 == 1 else pick.randrange(60) for i in range(3000)]
    table = spark.createDataFrame(list(enumerate(keys)), "id long, k long").repartition(6)
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "k long, v string")
    expected = sorted(((i, k, f"v{k}" if k is not None and k < 50 else None) for i, k in enumerate(keys)), key=str)
    return table, lookup, expected


def test_lookup_small_and_large_agree(hot, monkeypatch):
    table, lookup, expected = hot
    assert rows(lookup_join(table, lookup, ["k"]), "id", "k", "v") == expected
    for tasks in (1, 8, 1000):
        monkeypatch.setattr(lookups, "HOT_SHARE", tasks)
        large = lookup_join(table, lookup, ["k"], max_rows=10)
        assert rows(large, "id", "k", "v") == expected


def test_large_lookup_spreads_hot_and_keyless_rows(spark, hot):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = lookup_join(hot[0], hot[1], ["k"], max_rows=10)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        plain = hot[0].join(hot[1], "k", "left").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in sizes) == 3000
    assert max(r["count"] for r in sizes) < 600 and max(r["count"] for r in plain) > 1000


def test_lookup_by_two_columns(spark):
    table = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", "x")], "id long, p string, q string")
    lookup = spark.createDataFrame([("a", "x", 10)], "p string, q string, v long")
    expected = [(1, 10), (2, None), (3, None)]
    for limit in (0, 100):
        assert rows(lookup_join(table, lookup, ["p", "q"], max_rows=limit), "id", "v") == expected


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)


def test_natural_key_takes_least_id(spark):
    table = spark.createDataFrame([(5, "a"), (3, "a"), (4, None)], "id long, name string")
    assert rows(natural_key(table, {"n": "name"}, "id")) == [("a", 3)]


# --- first row wins, append -------------------------------------------------------------------------
def test_first_rows_limits_before_the_shuffle(spark, hot):
    table, _, _ = hot
    first = first_rows(table.dropna(), ["k"], ["id"])
    expected = {}
    for i, k, _ in sorted(hot[2]):
        if k is not None:
            expected.setdefault(k, i)
    assert dict((k, i) for i, k in rows(first, "id", "k")) == expected
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") == 2  # partial and final


def test_winners_are_joined_on_the_row_number(spark, hot):
    table, _, _ = hot
    existing = spark.createDataFrame([(3,), (7,)], "k long")
    marked = mark_winners(table, F.col("k").isNotNull(), ["k"], "id", "won", existing)
    seen, expected = {3, 7, None}, []
    for i, k, _ in sorted(hot[2]):
        expected.append((i, k not in seen))
        seen.add(k)
    assert sorted(rows(marked, "id", "won")) == sorted(expected)


def test_insert_if_absent_twice(spark):
    batch = spark.createDataFrame([(1, "a", 10), (2, "a", 11), (3, "b", 12), (4, "c", 13)], "id long, k string, v long")
    target = spark.createDataFrame([("c", 99)], "k string, v long")
    fresh = insert_if_absent(batch, target, ["k"], ["id"])
    assert rows(fresh, "id", "k", "v") == [(1, "a", 10), (3, "b", 12)]
    assert insert_if_absent(batch, target.unionByName(fresh.select("k", "v")), ["k"], ["id"]).count() == 0


def test_rows_of_a_key_and_an_order_are_not_sorted(spark):
    table = spark.createDataFrame([(3, "a", 1), (1, "a", 1), (2, None, 1), (5, None, 1), (None, "b", 2), (4, "b", 2), (4, "b", 2)],
                                  "id long, k string, g long")
    target = spark.createDataFrame([("a", 1, 9), ("a", 1, 9)], "k string, g long, month long")
    delta = append_delta(table, target, ["k", "g"], ["id"], [], {"_old_month": F.col("month")})
    assert rows(delta) == sorted([(2, None, 1, False, None), (None, "b", 2, False, None)], key=str)
    wider = append_delta(table.withColumn("more", F.lit(0)), target, ["k", "g"], ["id"], [], {"_old_month": F.col("month")})
    assert rows(wider.drop("more")) == rows(delta) and "Window" in plan_of(wider) and "Window" not in plan_of(delta)
    assert dict(delta.dtypes)["_old_month"] == "bigint"


def test_append_delta_and_upsert(spark):
    batch = spark.createDataFrame(
        [(1, "a", 10), (2, "b", None), (3, "c", 12), (4, "d", None)], "id long, k string, v long")
    target = spark.createDataFrame([("a", 10), ("b", 5), ("d", None)], "k string, v long")
    assert rows(append_delta(batch, target, ["k"], ["id"], ["v"]), "k", "v", "refreshes") == [
        ("b", None, True), ("c", 12, False)]
    assert rows(append_delta(batch, target, ["k"], ["id"], []), "k", "refreshes") == [("c", False)]
    assert rows(upsert(target, batch, ["k"], ["id"], ["v"]), "k", "v") == [
        ("a", 10), ("b", None), ("c", 12), ("d", None)]


# --- surrogate keys ---------------------------------------------------------------------------------
@pytest.mark.parametrize("spread", [1, 7, 10**9, 10**15])
def test_numbers_are_dense_and_ordered(spark, spread):
    ids = [i * spread - 3 * spread for i in range(500)]
    table = spark.createDataFrame([(i,) for i in random.Random(2).sample(ids, len(ids))], "id long")
    for parts, width in ((1, 1_000_000), (5, 16)):
        numbered = number_rows(table.repartition(parts), "id", "sk", start=10, width=width)
        assert sorted(rows(numbered, "id", "sk")) == [(i, 11 + n) for n, i in enumerate(ids)]


def test_numbers_skip_rows(spark):
    table = spark.range(20)
    numbered = number_rows(table, "id", "sk", where=F.col("id") % 3 == 0, width=4)
    assert sorted(rows(numbered, "id", "sk")) == [(i, i // 3 + 1 if i % 3 == 0 else None) for i in range(20)]


# --- as-of ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("grain", ["DAY", "MONTH"])
def test_event_versions_match_brute_force(spark, inclusive, grain):
    pick = random.Random(3)
    versions, start = [], datetime(2020, 1, 1)
    for key in range(6):
        at = start + timedelta(hours=pick.randrange(200))
        for n in range(pick.randrange(1, 9)):
            end = at + timedelta(hours=pick.choice([1, 5, 30, 900]))
            versions.append((key, at, end, f"{key}/{n}"))
            at = end + timedelta(seconds=pick.choice([0, 1, 7200])) if not inclusive else end + timedelta(seconds=1)
    edges = [t for v in versions for t in v[1:3]]
    facts = [(i, pick.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, None]),
              pick.choice(edges) if i % 2 else start + timedelta(minutes=pick.randrange(400_000)))
             for i in range(800)]
    facts.append((9000, 0, None))

    def expected(fact):
        i, key, at = fact
        found = [v[3] for v in versions if at and v[0] == key and v[1] <= at and (at <= v[2] if inclusive else at < v[2])]
        return i, found[0] if found else None

    dim = spark.createDataFrame(
        versions, "source_id long, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    table = spark.createDataFrame(facts, "id long, k long, at timestamp_ntz")
    for strategy in ("broadcast", "carry"):
        joined = prepare_at_event(table, dim, "k", {"version": "name"}, "at", inclusive, grain, strategy)(table)
        assert sorted(rows(joined, "id", "version"), key=lambda r: r[0]) == [expected(f) for f in facts]


@pytest.mark.parametrize("inclusive", [True, False])
def test_event_versions_of_any_shape(spark, inclusive):
    """Empty, touching, overlapping and equal-start versions: the last to start answers, in either way of joining."""
    pick = random.Random(11)
    day = datetime(2024, 1, 1)
    versions = []
    for key in range(12):
        for n in range(6):
            begin = day + timedelta(days=pick.randrange(8))
            versions.append((key, begin, begin + timedelta(days=pick.choice([0, 0, 1, 3, 9])), f"{n}"))
    facts = [(i, i % 13, day + timedelta(hours=12 * pick.randrange(36))) for i in range(400)]

    def expected(fact):
        i, key, at = fact
        begun = [(b, e, n) for k, b, e, n in versions if k == key and b <= at and (b <= e if inclusive else b < e)]
        last = max(begun, default=None)
        covers = last and (at <= last[1] if inclusive else at < last[1])
        return i, last[2] if covers else None

    dim = spark.createDataFrame(versions, "source_id long, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    table = spark.createDataFrame(facts, "id long, k long, at timestamp_ntz")
    for strategy in ("broadcast", "carry"):
        joined = prepare_at_event(table, dim, "k", {"version": "name"}, "at", inclusive, "DAY", strategy)(table)
        assert sorted(rows(joined, "id", "version"), key=lambda r: r[0]) == [expected(f) for f in facts]


def test_batch_version(spark):
    dim = spark.createDataFrame([
        (1, 10, datetime(2020, 1, 1), datetime(2020, 12, 31)), (1, 11, datetime(2021, 1, 1), datetime(9999, 12, 31)),
        (2, 12, datetime(2020, 1, 1), datetime(2020, 12, 31)),
    ], "source_id long, sk long, valid_from timestamp_ntz, valid_to timestamp_ntz")
    table = spark.createDataFrame([(1,), (2,), (3,)], "k long")

    def at(moment, inclusive=True):
        return rows(prepare_at_batch(table, dim, "k", {"sk": "sk"}, moment, inclusive)(table))

    assert at(datetime(2020, 6, 1)) == [(1, 10), (2, 12), (3, None)]
    assert at(datetime(2022, 1, 1)) == [(1, 11), (2, None), (3, None)]
    assert at(datetime(2020, 12, 31)) == [(1, 10), (2, 12), (3, None)]
    assert at(datetime(2020, 12, 31), inclusive=False) == [(1, None), (2, None), (3, None)]


# --- rollups and reports ----------------------------------------------------------------------------
def payments(spark, *given):
    return spark.createDataFrame(
        [(t, Decimal(a), m) for t, a, m in given],
        "transaction_id long, amount decimal(10,2), payment_method string")


def test_rollup_lists_distinct_methods(spark):
    table = payments(spark, (1, "10", "Cash"), (1, "5.5", "Debit Card"), (1, "1", "Cash"), (2, "3", None))
    assert rows(rollups.payment_rollup(table)) == [(1, Decimal("16.50"), "Cash, Debit Card"), (2, Decimal("3.00"), None)]


@pytest.mark.parametrize("size", [0, 1, 3, 30])
def test_rollup_cuts_long_lists_exactly(spark, size):
    pick = random.Random(size)
    methods = {"".join(pick.choice("abcxyz") for _ in range(pick.randrange(min(size, 1), size + 1))) for _ in range(60)}
    table = payments(spark, *[(1, "1", m) for m in methods for _ in range(2)])
    assert rollups.payment_rollup(table).first()["payment_method"] == ", ".join(sorted(methods))[:50]


def test_totals_are_zero_without_payments(spark):
    rentals = spark.createDataFrame(
        [(1, 1, 1, 1, date(2024, 1, 1), date(2024, 1, 2)), (2, 1, 1, 1, date(2024, 1, 1), date(2024, 1, 2))],
        "transaction_id long, customer_id long, vehicle_id long, employee_id long, rental_start_date date, "
        "rental_end_date date")
    totals = rollups.rental_totals(rentals, payments(spark, (1, "2", "a"), (1, "3", "b"), (9, "7", "c")))
    assert rows(totals, "transaction_id", "total_cost") == [(1, Decimal("5.00")), (2, Decimal("0.00"))]


def test_profit_fanout_equals_the_pairs(spark):
    pick = random.Random(4)
    fact = [(v, Decimal(pick.randrange(100)) if pick.random() < 0.8 else None) for v in [1] * 40 + list(range(1, 12))]
    cost = [(pick.randrange(1, 9), Decimal(pick.randrange(20))) for _ in range(50)]
    vehicles = spark.createDataFrame([(v, "m", "n", f"p{v}") for v in range(1, 12)],
                                     "vehicle_id long, make string, model string, license_plate string")
    f = spark.createDataFrame(fact, "vehicle_id long, payment_amount decimal(10,2)")
    m = spark.createDataFrame(cost, "vehicle_id long, maintenance_cost decimal(10,2)")
    pairs = f.join(m, "vehicle_id", "left").groupBy("vehicle_id").agg(
        F.coalesce(F.sum("payment_amount"), F.lit(0)).alias("r"), F.coalesce(F.sum("maintenance_cost"), F.lit(0)).alias("c"))
    expected = sorted(((f"p{x.vehicle_id}", x.r, x.c, x.r - x.c) for x in pairs.filter("r > 0").collect()),
                      key=lambda t: (-t[3], int(t[0][1:])))
    got = insights.profit_fanout(vehicles, f, m, k=100)
    assert [tuple(r)[2:] for r in got.collect()] == expected
    assert "CartesianProduct" not in plan_of(got)


def test_labels():
    assert insights.LABELS["net_profit"] == "Net Profit ($)"


# --- changes, control -------------------------------------------------------------------------------
def test_updates_stamp_touched_rows(spark):
    old, now = datetime(2024, 1, 1), datetime(2024, 2, 1)
    base = spark.createDataFrame([(1, "a", old), (2, "b", old), (3, "c", old)],
                                 "id long, v string, last_modified timestamp_ntz")
    updates = spark.createDataFrame([(1, "a"), (2, None), (9, "z")], "id long, v string")
    assert rows(apply_updates(base, updates, "id", now)) == [(1, "a", now), (2, None, now), (3, "c", old)]


def test_updates_name_a_row_once(spark):
    base = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "id long, v string, last_modified timestamp_ntz")
    for twice in ([(1, "x"), (1, "y")], [(None, "x")]):
        with pytest.raises(ValueError, match="more than once"):
            apply_updates(base, spark.createDataFrame(twice, "id long, v string"), "id", datetime(2024, 2, 1))


def test_broadcast_is_checked_in_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=50_000) and not fits_broadcast(wide, max_rows=99)


def test_watermark_is_strict(spark):
    control = control_rows(spark, [success("a", datetime(2024, 1, 1), 3), failure(datetime(2024, 5, 1), "x"),
                                   ("a", datetime(2024, 2, 1), "ERROR", None, "y")], 4)
    assert [r.etl_id for r in control.collect()] == [5, 6, 7]
    mark = watermark(control, "a").first()[0]
    assert mark == datetime(2024, 2, 1)
    assert watermark(control, "never").first()[0] == datetime(1900, 1, 1)
    source = spark.createDataFrame([(1, mark), (2, mark + timedelta(seconds=1))], "id long, last_modified timestamp_ntz")
    assert rows(changed_since(source, mark), "id") == [(2,)]
    assert rows(changed_since(source, mark, overlap="10 minutes"), "id") == [(1,), (2,)]
    assert rows(latest_runs(control), "source_table", "status", "runs") == [("ETL_FULL", "ERROR", 1), ("a", "ERROR", 2)]


def test_watermark_reaches_the_scan(spark, tmp_path):
    source = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id long, last_modified timestamp_ntz")
    source.write.parquet(str(tmp_path / "t"))
    plan = plan_of(changed_since(spark.read.parquet(str(tmp_path / "t")), datetime(2024, 1, 1)))
    assert "GreaterThan(last_modified,2024-01-01" in plan


# --- quality ----------------------------------------------------------------------------------------
def test_constraint_report(spark):
    stamp = datetime(2024, 1, 1)
    customers = spark.createDataFrame([
        (1, "a", "b", "e1", "5", None, stamp), (1, None, "b", "e1", "1234567890123456", None, stamp),
        (2, "x" * 51, "b", "e1", None, None, stamp),
    ], S.CUSTOMER.struct)
    rentals = spark.createDataFrame(
        [(i, 1 if i < 3 else 8, 1, 1, date(2024, 1, 1), date(2024, 1, 1), stamp) for i in range(5)], S.RENTAL.struct)
    report = quality.constraint_report({"customer": customers, "rental_transaction": rentals}, S.OLTP)
    assert [r for r in rows(report) if r[2]] == [
        ("customer", "length:first_name", 1), ("customer", "length:phone_number", 1),
        ("customer", "not_null:first_name", 1), ("customer", "primary_key:customer_id", 1),
        ("customer", "unique:email", 2), ("rental_transaction", "foreign_key:customer_id", 2),
    ]


def test_price_range(spark):
    values = spark.createDataFrame([("99999999.99",), ("100000000",), ("x",), (None,)], "v string")
    assert [r[0] for r in values.select(quality.fits_price(F.col("v"))).collect()] == [True, False, False, True]


def test_defaults_keep_given_nulls(spark):
    base = spark.createDataFrame([(1, "m", "n", 2020, "p", 1, 1)], "vehicle_id long, make string, model string, "
                                 "production_year int, license_plate string, vehicle_type_id long, branch_id long")
    row = quality.apply_defaults(base, S.VEHICLE, datetime(2024, 1, 1)).first()
    assert row.rental_availability is True and row.last_modified == datetime(2024, 1, 1)
    given = base.withColumn("rental_availability", F.lit(None).cast("boolean"))
    assert quality.apply_defaults(given, S.VEHICLE, datetime(2024, 1, 1)).first().rental_availability is None


def payments_of(spark, values):
    return spark.createDataFrame([(i, t, Decimal(a), m) for i, t, a, m in values],
                                 "payment_id long, transaction_id long, amount decimal(10,2), payment_method string")


def test_maintained_state_equals_a_full_computation(spark):
    before = payments_of(spark, [(1, 1, "10.00", "cash"), (2, 1, "5.00", "card"), (3, 2, "7.00", "cash"), (4, 3, "1.00", None), (5, 4, "2.00", "cash")])
    after = payments_of(spark, [(1, 1, "10.00", "cash"), (2, 2, "5.00", "card"), (3, 2, "8.00", "voucher"), (5, 4, "2.00", "cash"), (6, 9, "3.00", "cash")])
    told = maintained.payment_changes(before, after)
    assert rows(told, "payment_id", "kind") == [(2, "correct"), (3, "correct"), (4, "retract"), (6, "insert")]

    def whole(payments):
        return maintained.delta(payments.withColumn("sign", F.lit(1)))

    kept = maintained.merged(whole(before), maintained.delta(maintained.signed(told)))
    assert rows(kept, *maintained.STATE, "payments", "amount") == rows(whole(after), *maintained.STATE, "payments", "amount")
    assert maintained.unfounded(kept).isEmpty()
    again = maintained.merged(kept, maintained.delta(maintained.signed(told.filter("kind = 'retract'"))))
    assert rows(maintained.unfounded(again), "transaction_id", "payments") == [(3, -1)]
    rentals = spark.range(1, 5).withColumnRenamed("id", "transaction_id")
    assert rows(maintained.maintained_totals(rentals, kept)) == [
        (1, Decimal("10.00"), "cash"), (2, Decimal("13.00"), "card, voucher"), (3, Decimal("0.00"), None), (4, Decimal("2.00"), "cash")]


def test_boundary_keeps_rows_of_equal_stamps(spark):
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    make = lambda values: spark.createDataFrame(values, "k long, last_modified timestamp_ntz")
    none = changes.boundary(make([]), "k")
    first = changes.changed_from(make([(1, day[0]), (2, day[1]), (3, None)]), none, "k")
    assert rows(first, "k") == [(1,), (2,)]
    mark = changes.boundary(first, "k", earlier=none)
    second = changes.changed_from(make([(1, day[0]), (2, day[1]), (4, day[1]), (5, day[2])]), mark, "k")
    assert rows(second, "k") == [(4,), (5,)]
    assert rows(changes.boundary(make([]), "k", earlier=mark)) == [(day[1], 2)]
    more = changes.boundary(make([(4, day[1])]), "k", earlier=mark)
    assert rows(more) == [(day[1], 2), (day[1], 4)]
    assert changes.changed_from(make([(2, day[1]), (4, day[1])]), more, "k").isEmpty()


@pytest.mark.parametrize("inclusive", [True, False])
def test_crowded_slices_are_cut_where_their_times_lie(spark, monkeypatch, inclusive):
    """One key with very many times in one day, and versions that begin, end and touch amid them."""
    start = datetime(2024, 1, 1)
    times = [(1, start + timedelta(seconds=7 * i)) for i in range(4000)] + [(2, start + timedelta(hours=i)) for i in range(60)] + [(None, start), (1, None)]
    base = spark.createDataFrame(times, "k long, t timestamp_ntz").withColumn("row", F.monotonically_increasing_id())
    versions = [(1, start + timedelta(minutes=20 * i), start + timedelta(minutes=20 * i + (15 if i % 3 else 20)), i) for i in range(-1, 25)]
    versions += [(1, start + timedelta(minutes=40), start + timedelta(minutes=40), 99), (2, start, start + timedelta(days=1), 5)]
    dim = spark.createDataFrame(versions, "source_id long, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")

    def answer(strategy):
        return rows(asof.prepare_at_event(base, dim, "k", {"v": "v"}, "t", inclusive, strategy=strategy)(base), "row", "v")

    want = answer("broadcast")
    assert answer("carry") == want
    monkeypatch.setattr(asof, "SLICE_ROWS", 50)
    assert answer("carry") == want
    both = base.filter("k IS NOT NULL AND t IS NOT NULL").select("k", F.col("t").alias("_t")).withColumn("_slice", F.date_trunc("DAY", "_t").cast("timestamp_ntz"))
    crowded = both.groupBy("k", "_slice").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 50")
    sizes = [r["count"] for r in asof._cut_slices(both, crowded, "k").filter("k = 1").groupBy("_cut").count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 120


def test_numbering_spreads_small_tables(spark):
    ids = spark.range(600_000).withColumn("id", F.col("id") * 1)
    sizes = ids.groupBy((F.col("id") / WIDTH).cast("long").alias("r")).count().collect()
    assert len(sizes) >= 9 and max(r["count"] for r in sizes) <= WIDTH
    sparse = spark.createDataFrame([(2 ** 62,), (5,), (-7,), (2 ** 40,), (WIDTH,), (-(2 ** 62),)], "id long")
    assert rows(number_rows(sparse, "id", "n", start=10)) == sorted(
        [(v, 11 + i) for i, v in enumerate(sorted([2 ** 62, 5, -7, 2 ** 40, WIDTH, -(2 ** 62)]))], key=str)


def test_rollup_of_crowded_rentals_takes_the_same_values(spark):
    table = spark.createDataFrame(
        [(1, Decimal("1.00"), f"m{k % 30:02d}") for k in range(60)] + [(2, Decimal("2.00"), None), (None, Decimal("3.00"), "x"), (3, None, "y")],
        "transaction_id long, amount decimal(10,2), payment_method string")
    calm = rows(rollups.payment_rollup(table))
    assert rows(rollups.payment_rollup(table, most=10)) == calm
    assert (1, Decimal("60.00"), ", ".join(f"m{k:02d}" for k in range(30))[:50]) in calm
    assert (None, Decimal("3.00"), None) in calm


def test_rollup_moves_payments_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 100 AS transaction_id", "CAST(id AS decimal(10,2)) AS amount", "'m' || id AS payment_method").write.parquet(
        str(tmp_path / "payments"))
    assert plan_of(rollups.payment_rollup(spark.read.parquet(str(tmp_path / "payments")))).count("Exchange") == 1


def test_large_dimension_with_few_versions_is_looked_up_by_key(spark, monkeypatch):
    base = spark.sql("SELECT id AS row, CASE WHEN id % 9 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS k, "
                     "date_add(DATE '2020-01-01', CAST(id % 40 AS int)) AS t FROM range(600)")
    dim = spark.sql("SELECT k AS source_id, k * 10 + v AS v, TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_interval(0, 0, 0, v * 10) AS valid_from, "
                    "TIMESTAMP_NTZ '2020-01-06 00:00:00' + make_interval(0, 0, 0, v * 10) AS valid_to "
                    "FROM (SELECT id % 45 AS k, CAST(id div 45 AS int) AS v FROM range(180))")
    for inclusive in (True, False):
        wanted = rows(asof.prepare_at_event(base, dim, "k", {"v": "v"}, "t", inclusive, strategy="broadcast")(base), "row", "v")
        with monkeypatch.context() as small:
            small.setattr(asof, "fits_broadcast", lambda df: False)
            small.setattr("fleetmart.operators.lookup.BROADCAST_ROWS", 0)
            small.setattr("fleetmart.operators.lookup.fits_broadcast", lambda *_: False)
            small.setattr(asof, "_answers", lambda *_: pytest.fail("times are carried"))
            assert rows(asof.prepare_at_event(base, dim, "k", {"v": "v"}, "t", inclusive)(base), "row", "v") == wanted
