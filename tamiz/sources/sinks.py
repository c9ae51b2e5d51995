"""Report and prediction sinks. Each job overwrites its own sub-folder only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_reports(report: DataFrame, folder: str, algorithm: str) -> str:
    """All reports of a job as one table under ``<folder>/reports/algorithm=<algorithm>``; model names are
    values, as they hold characters that paths may not."""
    path = f"{folder.rstrip('/')}/reports/algorithm={algorithm}"
    # A few rows per model: one file.
    report.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/reports")


def write_report_csv(report: DataFrame, folder: str) -> str:
    """The same table as CSV with a header, the row name first."""
    path = f"{folder.rstrip('/')}/reports_csv"
    first = [c for c in ("model", "row") if c in report.columns]
    ordered = report.select(*first, *[c for c in report.columns if c not in first])
    return write_csv(ordered.coalesce(1), path)


def write_predictions(predictions: DataFrame, folder: str) -> str:
    path = f"{folder.rstrip('/')}/predictions"
    predictions.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    options = {"header": True, "emptyValue": "", "quote": '"', "escape": '"'}
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options, **spaces).csv(path)
    return path


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text through Spark's own writer, so that any file system works."""
    spark.range(1).select(F.lit(text).alias("text")).write.mode("overwrite").parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(path).select(F.col("text")).first()["text"]
