"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import date_key, day_label
from .append import insert_if_absent


def date_rows(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day between the two date columns of the one-row ``bounds``, both included."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key(F.col("full_date")).alias("date_id"),
        "full_date",
        F.dayofmonth("full_date").alias("day_of_month"),
        F.month("full_date").alias("month"),
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        day_label(F.col("full_date")).alias("day_of_week"),
    )


def date_span(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    return spark.range(1).select(F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end"))


def missing_dates(dim_date: DataFrame, bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Days of the span that the dimension lacks; days it has are kept as they are."""
    return insert_if_absent(date_rows(bounds, start, end), dim_date, ["full_date"], ["full_date"])
