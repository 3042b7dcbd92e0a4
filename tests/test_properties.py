"""Random inputs against small models in plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows

from fleetmart import schema as S
from fleetmart.operators import ingest, scd2

START = datetime(2024, 1, 1)


def model(histories, rules):
    """Versions as (key, name, text, from, to) after each run; to is None for a current one."""
    versions, counts = [], []
    for run, source in enumerate(histories):
        now, moved = START + timedelta(days=run), 0
        for key, (name, text) in sorted(source.items()):
            current = [v for v in versions if v[0] == key and v[4] is None]
            if current:
                old = current[0]
                plain = old[1] is not None and name is not None and old[1] != name
                if not plain and old[2] == text:
                    continue
                old[4] = now - timedelta(seconds=rules.gap)
                moved += 1
                if not rules.reopen:
                    continue
            versions.append([key, name, text, now, None])
            moved += 1
        counts.append(moved)
    return sorted((tuple(v) for v in versions), key=str), counts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rules", [scd2.CLOSE_ONLY, scd2.CLOSE_AND_INSERT])
def test_random_histories(spark, seed, rules):
    pick = random.Random(seed)

    def source():
        return {k: (pick.choice(["a", "b", None]), pick.choice(["x", "y", None])) for k in range(40) if pick.random() < 0.8}

    histories = [source() for _ in range(4)]
    expected, expected_counts = model(histories, rules)
    dim, counts = scd2.VEHICLE_TYPE.table.empty(spark), []
    for run, given in enumerate(histories):
        table = spark.createDataFrame([(k, *v) for k, v in given.items()],
                                      "source_id long, type_name string, description string").repartition(3)
        now = START + timedelta(days=run)
        delta = scd2.scd2_delta(scd2.current_versions(dim), table, scd2.VEHICLE_TYPE, now, rules)
        counts.append(sum(scd2.delta_counts(delta)))
        dim = scd2.scd2_merge(dim, table, scd2.VEHICLE_TYPE, now, rules)
    got = [(r.source_id, r.type_name, r.description, r.valid_from, None if r.is_active else r.valid_to)
           for r in dim.collect()]
    assert sorted(got, key=str) == expected
    assert counts == expected_counts
    keys = [r.vehicle_type_id for r in dim.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


@pytest.mark.parametrize("seed", [3, 4])
def test_loads_do_not_depend_on_partitions(spark, seed):
    pick = random.Random(seed)
    known = {"s": 1, "t": 2}
    given = [(i, "m", "n", 2020, f"P{pick.choice([0, 0, 0, *range(1, 60)])}", pick.choice(["s", "t", "u"]),
              pick.choice(["x", "y"]), pick.choice(["available", "out", None])) for i in range(1, 301)]
    seen, number, expected = {"P5"}, 900, []
    for i, *_, plate, kind, branch, status in given:
        reason = "unknown_vehicle_type" if kind not in known else "unknown_branch" if branch != "x" else None
        own = None
        if reason is None:
            number += 1
            own = number
            if plate in seen:
                reason = "duplicate_license_plate"
            seen.add(plate)
        expected.append((i, own, reason))
    feed = spark.createDataFrame(given, "seq long, make string, model string, production_year int, license_plate string, "
                                 "vehicle_type_name string, branch_name string, rental_status_text string")
    vehicle = spark.createDataFrame(
        [(900, "m", "n", 2020, "P5", 1, 1, True, START)], S.VEHICLE.struct)
    types = spark.createDataFrame([(v, k, None) for k, v in known.items()], S.VEHICLE_TYPE.struct)
    branches = spark.createDataFrame([(1, "x", "l", None)], S.BRANCH.struct)
    for parts in (1, 7):
        load = ingest.load_vehicles(feed.repartition(parts), vehicle, types, branches, START)
        assert sorted(rows(load.judged, "seq", "vehicle_id", "reject_reason")) == expected
        counted = {r.outcome: r.rows for r in load.outcome().collect()}
        assert sum(counted.values()) == len(given) and counted["accepted"] == load.accepted().count()
        assert load.rejects().count() == len(given) - counted["accepted"]
