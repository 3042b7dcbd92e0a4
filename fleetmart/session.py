"""Cutting lineage in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches. Taken from the session; only a local run may fall back to its own folder."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="fleetmart-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_scopes: list[list[str]] = []
_lock = threading.Lock()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder once, as Parquet, so later stages and lost executors re-read instead of recompute,
    and read only the columns they need."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/fleetmart/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    with _lock:
        for scope in _scopes:
            scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at its end what was staged within: for work that leaves nothing behind that still reads it."""
    own: list[str] = []
    with _lock:
        _scopes.append(own)
    try:
        yield
    finally:
        with _lock:
            _scopes[:] = [scope for scope in _scopes if scope is not own]
        for path in own:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
