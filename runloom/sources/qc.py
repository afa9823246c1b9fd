"""Read-QC reports: one JSON document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_COLUMNS = (
    "summary STRUCT<before_filtering: STRUCT<total_reads: DOUBLE, read1_mean_length: DOUBLE,"
    " read2_mean_length: DOUBLE>, after_filtering: STRUCT<total_reads: DOUBLE>>"
)


def read_qc_summaries(spark: SparkSession, path) -> DataFrame:
    """Summary of each report file with a reason when it cannot be used."""
    reports = spark.read.schema(REPORT_COLUMNS).option("multiLine", True).json(path)
    before, after = F.col("summary.before_filtering"), F.col("summary.after_filtering")
    summary = reports.select(
        F.col("_metadata.file_path").alias("file"),
        before["total_reads"].alias("before_reads"),
        after["total_reads"].alias("after_reads"),
        before["read1_mean_length"].alias("read1_mean_length"),
        before["read2_mean_length"].alias("read2_mean_length"),
    )
    return summary.withColumn("reason", summary_reason())


def summary_reason() -> Column:
    """Why a summary row is invalid, or null."""
    before, after = F.col("before_reads"), F.col("after_reads")
    first, second = F.col("read1_mean_length"), F.col("read2_mean_length")
    return F.when(
        before.isNull() | after.isNull() | first.isNull(), F.lit("required field is missing")
    ).when(
        (before <= 0) | (after < 0) | (after > before) | (first <= 0) | F.coalesce(second <= 0, F.lit(False)),
        F.lit("non-positive or inconsistent counts"),
    )
