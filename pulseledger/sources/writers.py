"""Target tables and exports on shared storage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger.schemas import CODE_TABLES, MONTH_OF, SUMMARIES, TARGETS, conform, empty_frame

# What to do when the table is already there.
WRITE_MODES: dict[str, str] = {
    "fail": "errorifexists",
    "replace": "overwrite",
    "append": "append",
    "delete_rows": "overwrite",
}


def write_table(df: DataFrame, root: str, table: str, if_exists: str = "append") -> None:
    """Write rows to a target table under ``root`` in its declared columns.

    ``delete_rows`` empties the table and keeps its columns, as ``replace`` does
    here, since the columns are fixed. Fact tables are partitioned by month; the
    rebalance evens out file sizes and splits a month that dominates. Overwriting
    replaces all months, whatever the session says about dynamic partitions.
    """
    write_rows(df, table, f"{root}/{table}", WRITE_MODES[if_exists])


def write_rows(df: DataFrame, table: str, path: str, mode: str) -> None:
    """The rows of a table in a folder, in its declared columns and by month."""
    rows = conform(df, table) if table in TARGETS or table in SUMMARIES else df
    column = MONTH_OF.get(table)
    if column is not None:
        rows = rows.withColumn("month", F.date_format(column, "yyyy-MM")).hint("rebalance", "month")
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    if column is not None:
        writer = writer.partitionBy("month")
    writer.parquet(path)


def write_snapshots(frames: Mapping[str, DataFrame], root: str) -> None:
    """Staged frames for inspection, one folder each."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{root}/snap_{name}")


def write_report(report: DataFrame, path: str, format: str = "csv") -> None:
    """The report in its row order; CSV with a header, or Parquet."""
    writer = report.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def reset_billing_tables(spark: SparkSession, root: str) -> None:
    """Empty all target tables."""
    for table, columns in TARGETS.items():
        write_table(empty_frame(spark, columns), root, table, "delete_rows")


def reset_code_tables(spark: SparkSession, root: str) -> None:
    """Empty the medical codes and their device links."""
    for table in CODE_TABLES:
        write_table(empty_frame(spark, TARGETS[table]), root, table, "delete_rows")
