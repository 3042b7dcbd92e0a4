from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from fleetmart.functions.expressions import (
    availability, changed, date_key, day_label, month_label, rounded_mean, whole_days,
)
from fleetmart.operators.calendar import date_rows, date_span, missing_dates
from fleetmart.schema import DIM_DATE
from fleetmart.seeds import seed_tables


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_labels_are_blank_padded(spark):
    monday, wednesday = F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 3))
    assert one(spark, day_label(monday), day_label(wednesday)) == ("Monday   ", "Wednesday")
    assert one(spark, month_label(F.lit(5)), month_label(F.lit(9))) == ("May      ", "September")


def test_availability(spark):
    texts = ["Available", "AVAILABLE", "Rented", None]
    assert one(spark, *[availability(F.lit(t).cast("string")) for t in texts]) == (True, True, False, False)


def test_change_tests(spark):
    null, a, b = F.lit(None).cast("string"), F.lit("a"), F.lit("b")
    assert one(spark, *[changed(x, y, False) for x, y in ((a, b), (a, a), (a, null), (null, null))]) == (
        True, False, False, False)
    assert one(spark, *[changed(x, y, True) for x, y in ((a, b), (a, a), (a, null), (null, null))]) == (
        True, False, True, False)


def test_rounding_is_half_away_from_zero(spark):
    def mean(total, n, scale):
        return rounded_mean(F.lit(Decimal(total)), F.lit(n), scale)

    assert one(spark, mean("5", 2, 0), mean("-5", 2, 0), mean("2400.05", 10, 2), mean("0.25", 2, 2)) == (
        Decimal(3), Decimal(-3), Decimal("240.01"), Decimal("0.13"))


def test_dates(spark):
    assert one(spark, date_key(F.lit(date(2024, 3, 9))), whole_days(F.lit(date(2024, 2, 27)), F.lit(date(2024, 3, 1)))
               ) == (20240309, 3)


def test_calendar_keeps_known_days(spark):
    span = date_span(spark, "2023-12-30", "2024-01-02")
    first = missing_dates(DIM_DATE.empty(spark), span, "start", "end")
    assert first.count() == 4
    row = first.filter("date_id = 20231231").first()
    assert (row.day_of_month, row.month, row.year, row.quarter, row.day_of_week) == (31, 12, 2023, 4, "Sunday   ")
    again = missing_dates(first, date_span(spark, "2023-12-30", "2024-01-04"), "start", "end")
    assert sorted(r.date_id for r in again.collect()) == [20240103, 20240104]
    assert date_rows(span, "start", "end").columns == DIM_DATE.names


def test_seeds(spark):
    tables = seed_tables(spark)
    assert {n: t.count() for n, t in tables.items()} == {"branch": 13, "employee": 26, "vehicle_type": 17}
    assert tables["branch"].filter("branch_id = 12").first()["contact_number"] == "0001112222"
