"""The analytic questions. Every one aggregates by id before it joins, so hot ids are combined on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import money, month_label, rounded_mean, whole_days


def top_rented(vehicles: DataFrame, totals: DataFrame, k: int = 5) -> DataFrame:
    """Most rented vehicles and their revenue."""
    per_vehicle = totals.groupBy("vehicle_id").agg(
        F.count("transaction_id").alias("rental_count"), money(F.sum("total_cost")).alias("total_revenue"))
    named = per_vehicle.join(vehicles.select("vehicle_id", "make", "model", "license_plate"), "vehicle_id")
    ranked = named.orderBy(F.desc_nulls_first("rental_count"), "vehicle_id").limit(k)
    return ranked.select("make", "model", "license_plate", "rental_count", "total_revenue")


def duration_by_type(types: DataFrame, vehicles: DataFrame, totals: DataFrame) -> DataFrame:
    """Average rental duration in days and average revenue per vehicle type."""
    days = whole_days(F.col("rental_start_date"), F.col("rental_end_date"))
    sums = (F.sum("_days").alias("_days"), F.count("_days").alias("_n_days"), F.sum("_cost").alias("_cost"),
            F.count("_cost").alias("_n_cost"))
    again = (F.sum("_days").alias("_days"), F.sum("_n_days").alias("_n_days"), F.sum("_cost").alias("_cost"),
             F.sum("_n_cost").alias("_n_cost"))
    per_vehicle = totals.select("vehicle_id", days.alias("_days"), F.col("total_cost").alias("_cost")).groupBy(
        "vehicle_id").agg(*sums)
    per_type = per_vehicle.join(vehicles.select("vehicle_id", "vehicle_type_id"), "vehicle_id").groupBy(
        "vehicle_type_id").agg(*again)
    named = per_type.join(types.select("vehicle_type_id", "type_name"), "vehicle_type_id").groupBy(
        "type_name").agg(*again)
    return named.select(
        F.col("type_name").alias("vehicle_type"),
        rounded_mean(F.col("_days"), F.col("_n_days"), 1).cast("decimal(18,1)").alias("avg_rental_days"),
        rounded_mean(F.col("_cost"), F.col("_n_cost"), 2).cast("decimal(18,2)").alias("avg_rental_revenue"),
    ).orderBy(F.desc_nulls_first("avg_rental_revenue"), "vehicle_type")


def _per_vehicle(fact_rental: DataFrame, fact_maintenance: DataFrame) -> DataFrame:
    revenue = fact_rental.groupBy("vehicle_id").agg(
        F.sum("payment_amount").alias("_revenue"), F.count(F.lit(1)).alias("_rentals"))
    cost = fact_maintenance.groupBy("vehicle_id").agg(
        F.sum("maintenance_cost").alias("_cost"), F.count(F.lit(1)).alias("_services"))
    return revenue.join(cost, "vehicle_id", "left")


def _profit(vehicles: DataFrame, sums: DataFrame, k: int) -> DataFrame:
    net = (F.col("total_revenue") - F.col("total_maintenance_cost")).cast("decimal(25,2)")
    earning = sums.filter(F.col("total_revenue") > 0).withColumn("net_profit", net)
    named = earning.join(vehicles.select("vehicle_id", "make", "model", "license_plate"), "vehicle_id")
    ranked = named.orderBy(F.desc_nulls_first("net_profit"), "vehicle_id").limit(k)
    return ranked.select("make", "model", "license_plate", "total_revenue", "total_maintenance_cost", "net_profit")


def profit_fanout(vehicles: DataFrame, fact_rental: DataFrame, fact_maintenance: DataFrame, k: int = 5) -> DataFrame:
    """Most profitable vehicles, where the sums run over all pairs of a vehicle's rentals and services.

    Each rental then counts once per service (once if there is none) and each service once per rental. That product is
    computed from the four sums per vehicle; the pairs are never formed.
    """
    revenue = F.col("_revenue") * F.greatest(F.coalesce("_services", F.lit(1)), F.lit(1)).cast("decimal(12,0)")
    cost = F.col("_cost") * F.col("_rentals").cast("decimal(12,0)")
    sums = _per_vehicle(fact_rental, fact_maintenance).select(
        "vehicle_id",
        money(F.coalesce(revenue, F.lit(0))).alias("total_revenue"),
        money(F.coalesce(cost, F.lit(0))).alias("total_maintenance_cost"),
    )
    return _profit(vehicles, sums, k)


def profit_preagg(vehicles: DataFrame, fact_rental: DataFrame, fact_maintenance: DataFrame, k: int = 5) -> DataFrame:
    """Most profitable vehicles, each rental and each service counted once."""
    sums = _per_vehicle(fact_rental, fact_maintenance).select(
        "vehicle_id",
        money(F.coalesce("_revenue", F.lit(0))).alias("total_revenue"),
        money(F.coalesce("_cost", F.lit(0))).alias("total_maintenance_cost"),
    )
    return _profit(vehicles, sums, k)


def monthly_revenue(fact_rental: DataFrame, vehicles: DataFrame, types: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and rentals per month of the rental start and vehicle type."""
    again = (F.sum("_revenue").alias("_revenue"), F.sum("_rentals").alias("_rentals"))
    dates = dim_date.select(F.col("date_id").alias("rental_start_date_id"), "year", "month")
    per_vehicle = fact_rental.join(F.broadcast(dates), "rental_start_date_id").groupBy(
        "year", "month", "vehicle_id").agg(
        F.sum("payment_amount").alias("_revenue"), F.count("transaction_id").alias("_rentals"))
    per_type = per_vehicle.join(vehicles.select("vehicle_id", "vehicle_type_id"), "vehicle_id").groupBy(
        "year", "month", "vehicle_type_id").agg(*again)
    named = per_type.join(types.select("vehicle_type_id", "type_name"), "vehicle_type_id").groupBy(
        "year", "month", "type_name").agg(*again)
    ordered = named.withColumn("monthly_revenue", money(F.col("_revenue"))).orderBy(
        "year", "month", F.desc_nulls_first("monthly_revenue"), "type_name")
    return ordered.select(
        "year", month_label(F.col("month")).alias("month"), F.col("type_name").alias("vehicle_type"),
        "monthly_revenue", F.col("_rentals").alias("rental_count"))


# Presentation labels of the four reports. Fixed values.
LABELS = {
    "make": "Make", "model": "Model", "license_plate": "License Plate", "rental_count": "Rental Count",
    "total_revenue": "Total Revenue ($)", "vehicle_type": "Vehicle Type",
    "avg_rental_days": "Average Rental Duration (Days)", "avg_rental_revenue": "Average Rental Revenue ($)",
    "total_maintenance_cost": "Total Maintenance Cost ($)", "net_profit": "Net Profit ($)", "year": "Year",
    "month": "Month", "monthly_revenue": "Monthly Revenue ($)",
}


def labelled(report: DataFrame) -> DataFrame:
    """The report under its presentation labels."""
    return report.select(*[F.col(c).alias(LABELS.get(c, c)) for c in report.columns])
