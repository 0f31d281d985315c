"""Source scans. Filters and column lists are plain ``where``/``select``, so they
reach the Parquet or JDBC scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger.functions.dates import Moment, between
from pulseledger.functions.vocabulary import CSV_NULLS, VENDORS_SUPPLIED
from pulseledger.operators.normalize import parsed_timestamp
from pulseledger.schemas import PATIENT_EXPORT_COLUMNS, SOURCES
from pulseledger.sources import versions

# Rows whose cleansing keeps a task busy for some seconds.
ROWS_PER_TASK = 25_000


def read_patient_export(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Patient export: every cell as text, the two dates parsed, by header name.

    Cells holding one of the usual "no value" texts are null. Large files are
    split; pass ``multi_line=True`` for exports with line breaks in quoted
    cells, which makes each file one task. A missing column is an error.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    missing = [name for name in PATIENT_EXPORT_COLUMNS if name not in names]
    if missing:
        raise ValueError(f"the export lacks the columns {missing}")
    text = ", ".join(f"`{name}` string" for name in names)
    cells = spark.read.options(**options, enforceSchema=False).schema(text).csv(path)
    parsed = {"DOB", "On-board Date"}

    def cell(name: str):
        value = F.when(~F.col(f"`{name}`").isin(*CSV_NULLS), F.col(f"`{name}`"))
        return (parsed_timestamp(value) if name in parsed else value).alias(name)

    return cells.select(*(cell(name) for name in names))


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Members of the landed directory documents (their ``value`` arrays)."""
    documents = spark.read.schema(SOURCES["directory"]).option("multiLine", True).json(path)
    return documents.select(F.inline("value"))


def read_source(
    spark: SparkSession, path: str, source: str | None = None, format: str = "parquet"
) -> DataFrame:
    """A landed source table; with ``source`` under its declared schema."""
    reader = spark.read.format(format)
    if source is not None:
        reader = reader.schema(SOURCES[source])
    return reader.load(path)


def in_even_pieces(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same rows, dealt out when one task would get more than ``rows_per_task`` of them.

    A Parquet file is split between its row groups only, and one of a narrow table
    holds a million rows. Use it on a source whose rows cost much more to work on
    than to read. The rows of each piece are counted first, which reads no column.
    """
    pieces = df.select(F.spark_partition_id().alias("piece")).groupBy("piece").count()
    largest, total = pieces.agg(F.max("count"), F.sum("count")).first()
    if (largest or 0) <= rows_per_task:
        return df
    return df.repartition(-(-total // rows_per_task))


def read_table(
    spark: SparkSession, path: str, date_columns: Iterable[str] = (), format: str = "parquet"
) -> DataFrame:
    """A stored table with the given text columns parsed as timestamps."""
    return with_timestamps(spark.read.format(format).load(path), date_columns)


def read_stored(
    spark: SparkSession, root: str, table: str, since: Moment | None = None
) -> DataFrame:
    """A target or summary table under its declared schema.

    Under a root whose tables are versioned (see ``versions``) that is the
    current version. For the tables stored by month, ``since`` reads only the months from then on
    (and within them only the rows from then on).
    """
    folders = versions.current_folders(spark, root).get(table, [f"{root}/{table}"])
    return versions.read_folders(spark, folders, table, since)


def with_timestamps(df: DataFrame, date_columns: Iterable[str]) -> DataFrame:
    return df.withColumns(
        {name: F.col(f"`{name}`").cast("timestamp_ntz") for name in date_columns}
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: str,
    upper_bound: str,
    partitions: int,
    date_columns: Iterable[str] = (),
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel ranges of ``partition_column``.

    The bounds only place the ranges; rows outside them are read as well.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=str(partitions),
        preferTimestampNTZ="true",
        **(properties or {}),
    )
    return with_timestamps(reader.load(), date_columns)


# --- windows of the operational logs -------------------------------------------


def glucose_window(glucose_log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return glucose_log.where(between(F.col("Time_Recorded"), start, end)).select(
        "SharePoint_ID",
        "Device_Model",
        "Time_Recorded",
        "Time_Recieved",
        "BG_Reading",
        "Manual_Reading",
    )


def pressure_window(pressure_log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return pressure_log.where(between(F.col("Time_Recorded"), start, end)).select(
        "SharePoint_ID",
        "Device_Model",
        "Time_Recorded",
        "Time_Recieved",
        "BP_Reading_Systolic",
        "BP_Reading_Diastolic",
        "Manual_Reading",
    )


def notes_window(notes_log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return notes_log.where(between(F.col("TimeStamp"), start, end)).select(
        "SharePoint_ID", "Notes", "TimeStamp", "LCH_UPN", "Time_Note", "Note_ID"
    )


def time_window(time_log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return time_log.where(between(F.col("End_Time"), start, end)).select(
        "SharPoint_ID",
        "Recording_Time",
        "LCH_UPN",
        "Notes",
        "Auto_Time",
        "Start_Time",
        "End_Time",
        "Note_ID",
    )


def supplied_devices(fulfillment: DataFrame) -> DataFrame:
    """First shipments of the supplied vendors (no resupplies)."""
    first = ~F.col("Resupply").cast("boolean")
    return fulfillment.where(first & F.col("Vendor").isin(*VENDORS_SUPPLIED)).select(
        "Vendor", "Device_ID", "Device_Name", "Patient_ID"
    )
