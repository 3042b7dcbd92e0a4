from datetime import datetime, timedelta

import pytest
from helpers import rows

from fleetmart.functions.expressions import EPOCH
from fleetmart.operators import scd2

RUNS = [datetime(2024, 1, d) for d in (1, 2, 3)]
HIGH = datetime(9999, 12, 31)
SHOW = ("vehicle_type_id", "source_id", "type_name", "description", "valid_from", "valid_to", "is_active")


def types(spark, *given):
    return spark.createDataFrame(list(given), "source_id long, type_name string, description string")


def merged(spark, sources, rules):
    dim = scd2.VEHICLE_TYPE.table.empty(spark)
    for ts, source in zip(RUNS, sources):
        dim = scd2.scd2_merge(dim, source, scd2.VEHICLE_TYPE, ts, rules)
    return dim


def scenario(spark):
    """Run 1 loads 1..5. Run 2: 1 renamed, 2 loses its description, 3 unchanged, 4 gone, 5 renamed, 6 new.
    Run 3: 1 and 2 as in run 2, 5 back under its first name."""
    return [
        types(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "z"), (5, "e", "w")),
        types(spark, (1, "A", "x"), (2, "b", None), (3, "c", None), (5, "E", "w"), (6, "f", "v")),
        types(spark, (1, "A", "x"), (2, "b", None), (3, "c", None), (5, "e", "w"), (6, "f", "v")),
    ]


def test_close_only_opens_the_new_version_one_run_later(spark):
    sources = scenario(spark)
    closed = RUNS[1] - timedelta(seconds=1)
    second = merged(spark, sources[:2], scd2.CLOSE_ONLY)
    assert rows(second, *SHOW) == [
        (1, 1, "a", "x", RUNS[0], closed, False), (2, 2, "b", "y", RUNS[0], closed, False),
        (3, 3, "c", None, RUNS[0], HIGH, True), (4, 4, "d", "z", RUNS[0], HIGH, True),
        (5, 5, "e", "w", RUNS[0], closed, False), (6, 6, "f", "v", RUNS[1], HIGH, True),
    ]
    third = merged(spark, sources, scd2.CLOSE_ONLY)
    new = [r for r in rows(third, *SHOW) if r[4] == RUNS[2]]
    assert new == [(7, 1, "A", "x", RUNS[2], HIGH, True), (8, 2, "b", None, RUNS[2], HIGH, True),
                   (9, 5, "e", "w", RUNS[2], HIGH, True)]


def test_close_and_insert_leaves_no_gap(spark):
    third = merged(spark, scenario(spark), scd2.CLOSE_AND_INSERT)
    versions = [r[:3] + r[4:] for r in rows(third, *SHOW)]
    assert [v for v in versions if v[1] == 5] == [
        (10, 5, "e", RUNS[2], HIGH, True), (5, 5, "e", RUNS[0], RUNS[1], False), (8, 5, "E", RUNS[1], RUNS[2], False)]
    assert [v for v in versions if v[1] == 4] == [(4, 4, "d", RUNS[0], HIGH, True)]
    current = [v[1] for v in versions if v[4] == HIGH]
    assert sorted(current) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("rules", [scd2.CLOSE_ONLY, scd2.CLOSE_AND_INSERT])
def test_rerun_changes_nothing(spark, rules):
    source = types(spark, (1, "a", None), (2, None, "y"))
    once = merged(spark, [source], rules)
    assert rows(merged(spark, [source, source, source], rules)) == rows(once)


def test_plain_test_ignores_null_and_null_safe_does_not(spark):
    first = types(spark, (1, "a", "x"), (2, "b", "x"))
    second = types(spark, (1, None, "x"), (2, "b", None))
    got = rows(merged(spark, [first, second], scd2.CLOSE_AND_INSERT), "source_id", "type_name", "is_active")
    assert got == [(1, "a", True), (2, "b", False), (2, "b", True)]


def test_large_source_takes_the_shuffle(spark, monkeypatch):
    expected = rows(merged(spark, scenario(spark), scd2.CLOSE_AND_INSERT))
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: False)
    assert rows(merged(spark, scenario(spark), scd2.CLOSE_AND_INSERT)) == expected


def test_source_with_a_key_twice_fails(spark):
    with pytest.raises(ValueError, match="more than once"):
        merged(spark, [types(spark, (1, "a", "x"), (1, "b", "x"))], scd2.CLOSE_AND_INSERT)


def test_first_version_may_start_early(spark):
    rules = scd2.Versioning(first_from=EPOCH)
    got = merged(spark, scenario(spark)[:2], rules)
    starts = {(r.source_id, r.type_name): r.valid_from for r in got.collect()}
    assert starts[(1, "a")] == starts[(6, "f")] == datetime(1900, 1, 1) and starts[(1, "A")] == RUNS[1]


def test_dimension_layouts():
    assert scd2.CUSTOMER.table.names == [
        "customer_id", "source_id", "first_name", "last_name", "email", "phone_number", "address", "valid_from",
        "valid_to", "is_active", "last_modified"]
    for spec in (scd2.VEHICLE_TYPE, scd2.BRANCH, scd2.CUSTOMER, scd2.VEHICLE, scd2.EMPLOYEE):
        assert list(spec.compare) == spec.business
    assert [s.table.name for s in (scd2.CUSTOMER, scd2.VEHICLE) if s.incremental] == ["dim_customer", "dim_vehicle"]
