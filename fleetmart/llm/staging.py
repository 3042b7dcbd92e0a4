"""Results that are used more than once, written as Parquet to the shared folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from fleetmart.session import shared_dir


def staged(df: DataFrame) -> DataFrame:
    """Later jobs and lost executors read the files and don't compute df again."""
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
