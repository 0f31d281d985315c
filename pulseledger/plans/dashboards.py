"""The dashboards and the study extract over stored tables and summaries.

They read summaries in place of readings, and of the notes only the months asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseledger.functions.dates import Moment, month_start_of
from pulseledger.operators import reports, summaries
from pulseledger.sources.readers import read_stored


def _board(spark: SparkSession, root: str, as_of: Moment) -> list:
    readings = reports.SummedReadings(
        read_stored(spark, root, "reading_day", since=month_start_of(as_of)),
        read_stored(spark, root, "device_last_reading"),
    )
    return [
        read_stored(spark, root, "patient_status"),
        read_stored(spark, root, "patient_address"),
        read_stored(spark, root, "patient_note", since=month_start_of(as_of)),
        read_stored(spark, root, "device"),
        readings,
    ]


def coach_queue(
    spark: SparkSession, root: str, display_name: str, as_of: Moment, distinct: bool = True
) -> DataFrame:
    """``reports.coach_board`` of the tables under ``root``."""
    patient, user = read_stored(spark, root, "patient"), read_stored(spark, root, "user")
    return reports.coach_board(patient, user, *_board(spark, root, as_of), display_name, as_of, distinct)


def patient_search(spark: SparkSession, root: str, as_of: Moment, **wanted) -> DataFrame:
    """``reports.search_board`` of the tables under ``root``."""
    patient = read_stored(spark, root, "patient")
    return reports.search_board(patient, *_board(spark, root, as_of), as_of, **wanted)


def study_extract(spark: SparkSession, root: str, as_of: Moment) -> DataFrame:
    """``reports.study_extract`` of the tables under ``root``."""
    names = ("patient", "patient_address", "patient_insurance", "medical_necessity", "device")
    days = read_stored(spark, root, "reading_day")
    return reports.study_extract(
        *(read_stored(spark, root, name) for name in names),
        summaries.readings_of(days, "glucose"),
        summaries.readings_of(days, "pressure"),
        as_of,
    )
