"""Stored summaries of readings and notes, so that no later run reads all history.

A load adds the rows of its own readings and notes (``reading_days``,
``talk_days``) and merges the latest reading per device. The rules and reports
read them as if they were readings and notes: one per device and day, or per
patient, type and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.operators.activity import both_kinds


def reading_days(glucose: DataFrame, pressure: DataFrame) -> DataFrame:
    """First and last reading per device, kind and day; reduced in the scan of the readings."""
    readings = both_kinds(glucose, pressure, ["device_id", "received_datetime"])
    return readings.groupBy(
        "device_id", "kind", F.to_date("received_datetime").alias("reading_day")
    ).agg(
        F.min("received_datetime").alias("first_reading"),
        F.max("received_datetime").alias("last_reading"),
    )


def talk_days(notes: DataFrame) -> DataFrame:
    """Call seconds and last note per patient, note type and day."""
    return notes.groupBy("patient_id", "note_type_id", F.to_date("note_datetime").alias("note_day")).agg(
        F.sum("call_time_seconds").alias("call_seconds"), F.max("note_datetime").alias("last_note")
    )


def merged_last_readings(stored: DataFrame, days: DataFrame) -> DataFrame:
    """The stored latest reading per device with those of new days."""
    new = days.select("device_id", F.col("last_reading").alias("last_reading_date"))
    both = stored.select("device_id", "last_reading_date").unionByName(new)
    return both.groupBy("device_id").agg(F.max("last_reading_date").alias("last_reading_date"))


def readings_of(days: DataFrame, kind: str) -> DataFrame:
    """The last reading of each device and day, under the readings' column names.

    Equal to the readings wherever only their days, their latest and a lower
    bound count.
    """
    return days.where(F.col("kind") == kind).select(
        "device_id", F.col("last_reading").alias("received_datetime")
    )


def notes_of(talk: DataFrame) -> DataFrame:
    """One note per patient, type and day, under the notes' column names.

    Equal to the notes wherever only sums, latest and a bound by whole days count.
    """
    return talk.select(
        "patient_id",
        "note_type_id",
        F.col("last_note").alias("note_datetime"),
        F.col("call_seconds").alias("call_time_seconds"),
    )


def window_days(days: DataFrame, since: Column, until: Column) -> DataFrame:
    """Per device: distinct reading days of each kind from the day ``since`` to the moment ``until``, summed.

    A day counts once its first reading is there.
    """
    seen = days.where((F.col("reading_day") >= since) & (F.col("first_reading") <= until))
    return (
        seen.select("device_id", "kind", "reading_day")
        .distinct()
        .groupBy("device_id")
        .agg(F.count("reading_day").alias("window_days"))
    )
