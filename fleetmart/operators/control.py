"""Run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S


FAILED_RUN = "ETL_FULL"  # fixed value: the table name of an error row


def control_rows(spark: SparkSession, rows: list[tuple], start: int) -> DataFrame:
    """Control rows (source_table, last_etl_time, status, records_processed, error_message), numbered after start."""
    return spark.createDataFrame([(start + i, *row) for i, row in enumerate(rows, 1)], S.ETL_CONTROL.struct)


def success(table: str, batch_ts: datetime, records: int) -> tuple:
    return table, batch_ts, "SUCCESS", records, None


def failure(batch_ts: datetime, message: str) -> tuple:
    return FAILED_RUN, batch_ts, "ERROR", None, message


def latest_runs(control: DataFrame) -> DataFrame:
    """Newest run per source table, with how many runs it had. One map-side combined aggregation."""
    newest = F.max_by(F.struct("status", "records_processed", "error_message"), F.struct("last_etl_time", "etl_id"))
    return control.groupBy("source_table").agg(
        F.max("last_etl_time").alias("last_etl_time"), newest.alias("_run"), F.count(F.lit(1)).alias("runs"),
    ).select("source_table", "last_etl_time", "_run.*", "runs")
