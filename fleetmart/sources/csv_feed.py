"""CSV feeds, bound by position and staged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import schema as S
from ..operators.ingest import CORRUPT, REASON
from ..operators.lookup import lookup_join
from ..operators.quality import column_checks
from ..session import cut_lineage


#: Stands for a field without text; no feed holds it. An empty field in quotes is empty text.
NO_TEXT = "\x00"


def scan_csv(spark: SparkSession, path: str | list[str], table: S.Table, strict: bool = True,
             multi_line: bool = False, header: bool = True) -> DataFrame:
    """Typed scan of one file, folder or pattern. The header is skipped and its names are ignored. A field without
    text is NULL, an empty one in quotes is empty text.

    ``strict`` fails the job on a bad value or a wrong number of fields; otherwise such rows keep their text in
    ``_corrupt_record``. ``multi_line`` allows line breaks in quoted fields, at the price of one task per file.
    """
    struct = table.struct if strict else T.StructType([*table.struct.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(struct).option("header", header).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("nullValue", NO_TEXT).option("emptyValue", "")
    reader = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def number_lines(scan: DataFrame) -> DataFrame:
    """Add ``seq``, 1..n in the order of file path and position. ``scan`` is a staged scan with ``_file``, ``_block``
    and ``_line``; the line ids of one block are consecutive, so only blocks are sorted within their file, and files
    among each other, never the rows."""
    blocks = scan.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_files_before"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_blocks_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        files, "_file").select("_file", "_block", "_first", (F.col("_blocks_before") + F.col("_files_before")).alias("_offset"))
    placed = lookup_join(scan, offsets, ["_file", "_block"])
    seq = F.col("_line") - F.col("_first") + F.col("_offset") + 1
    return placed.withColumn("seq", seq.cast("long")).drop("_file", "_block", "_line", "_first", "_offset")


def read_feed(spark: SparkSession, path: str | list[str], table: S.Table, strict: bool = True,
              multi_line: bool = False, header: bool = True) -> DataFrame:
    """Stage a feed: parse every column once, check lengths, number the lines.

    Staging is written out, so the parse checks cover all columns whatever is read later, and a retried stage sees the
    same rows. With ``strict=False`` the column ``reject_reason`` marks rows that do not parse or are too long.
    """
    scan = scan_csv(spark, path, table, strict, multi_line, header).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    checks = column_checks(table, table.names)
    if strict:
        for failed, code in checks:
            scan = scan.filter(F.assert_true(~F.coalesce(failed, F.lit(False)), F.lit(code)).isNull())
        return number_lines(cut_lineage(scan))
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))]
    reasons += [F.when(failed, F.lit(code)) for failed, code in checks]
    staged = cut_lineage(scan.withColumn(REASON, F.coalesce(*reasons)))
    return number_lines(staged)
