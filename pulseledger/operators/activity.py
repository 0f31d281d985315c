"""Pre-aggregated patient activity: the small frames billing and reports work on.

Readings and notes are the big tables. Each is reduced inside its own scan
(map-side) before anything is joined to it, so a device or patient holding a
large share of all rows reaches the shuffle as a few rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.functions.dates import Moment, month_before
from pulseledger.session import materialise

INITIAL_EVALUATION = "Initial Evaluation"


def reading_days(readings: DataFrame) -> DataFrame:
    """One row per device and calendar day, with the day's last reading.

    A filter on ``reading_day`` reaches the scan of ``readings``.
    """
    return readings.groupBy(
        "device_id", F.to_date("received_datetime").alias("reading_day")
    ).agg(F.max("received_datetime").alias("last_reading"))


def patient_reading_days(device: DataFrame, readings: DataFrame) -> DataFrame:
    """Reading days of known devices, with their patient."""
    return device.select("device_id", "patient_id").join(reading_days(readings), "device_id")


def both_kinds(glucose: DataFrame, pressure: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Glucose and blood-pressure rows in one frame, told apart by ``kind``."""
    return glucose.select(F.lit("glucose").alias("kind"), *columns).unionByName(
        pressure.select(F.lit("pressure").alias("kind"), *columns)
    )


def latest_reading(glucose: DataFrame, pressure: DataFrame) -> DataFrame:
    """Latest reading of each device over both kinds, of all time."""
    readings = both_kinds(glucose, pressure, ["device_id", "received_datetime"])
    return readings.groupBy("device_id").agg(
        F.max("received_datetime").alias("last_reading_date")
    )


def device_month(
    glucose: DataFrame, pressure: DataFrame, in_window: Column
) -> DataFrame:
    """Per device: distinct reading days of each kind inside the window, summed,
    and the latest reading of all time.

    One pass: readings outside the window share the null day, which the count
    leaves out and the maximum takes in.
    """
    readings = both_kinds(glucose, pressure, ["device_id", "received_datetime"])
    days = readings.groupBy(
        "device_id",
        "kind",
        F.when(in_window, F.to_date("received_datetime")).alias("window_day"),
    ).agg(F.max("received_datetime").alias("last_reading"))
    return days.groupBy("device_id").agg(
        F.count("window_day").alias("window_days"),
        F.max("last_reading").alias("last_reading_date"),
    )


def talk_time(notes: DataFrame) -> DataFrame:
    """Call seconds and latest note per patient."""
    return notes.groupBy("patient_id").agg(
        F.sum("call_time_seconds").alias("call_seconds"),
        F.max("note_datetime").alias("last_note"),
    )


def notes_of_type(notes: DataFrame, note_type: DataFrame, name: str) -> DataFrame:
    wanted = note_type.where(F.col("name") == name).select("note_type_id")
    return notes.join(wanted, "note_type_id")


@dataclass(frozen=True)
class Activity:
    """What the billing rules read.

    ``glucose_days`` and ``pressure_days``: patient_id, device_id, reading_day,
    last_reading. ``intro_talk`` (initial evaluations, all time) and
    ``month_talk`` (the month before ``as_of`` and later): patient_id,
    call_seconds, last_note. ``last_notes``: patient_id, last_note of all time.
    """

    device: DataFrame
    glucose_days: DataFrame
    pressure_days: DataFrame
    intro_talk: DataFrame
    month_talk: DataFrame
    last_notes: DataFrame


def activity_scans(
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    notes: DataFrame,
    note_type: DataFrame,
    as_of: Moment,
) -> Activity:
    """Every part as its own scan: a rule used alone reads only what it needs."""
    return Activity(
        device=device,
        glucose_days=patient_reading_days(device, glucose),
        pressure_days=patient_reading_days(device, pressure),
        intro_talk=talk_time(notes_of_type(notes, note_type, INITIAL_EVALUATION)),
        month_talk=talk_time(notes.where(F.col("note_datetime") >= month_before(as_of))),
        last_notes=notes.groupBy("patient_id").agg(F.max("note_datetime").alias("last_note")),
    )


def activity_in_one_pass(
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    notes: DataFrame,
    note_type: DataFrame,
    as_of: Moment,
) -> Activity:
    """Every part for a whole billing run: each big table is read exactly once.

    The reduced frames are kept in reliable storage, since several rules read
    each of them.
    """
    scans = activity_scans(device, glucose, pressure, notes, note_type, as_of)
    intro_types = note_type.where(F.col("name") == INITIAL_EVALUATION).select(
        "note_type_id", F.lit(True).alias("is_intro")
    )
    tagged = notes.select(
        "patient_id", "note_type_id", "note_datetime", "call_time_seconds"
    ).join(intro_types, "note_type_id", "left")
    intro = F.col("is_intro")
    month = F.col("note_datetime") >= month_before(as_of)
    talk = materialise(
        tagged.groupBy("patient_id").agg(
            F.count_if(intro).alias("intro_notes"),
            F.sum(F.when(intro, F.col("call_time_seconds"))).alias("intro_seconds"),
            F.max(F.when(intro, F.col("note_datetime"))).alias("intro_last"),
            F.count_if(month).alias("month_notes"),
            F.sum(F.when(month, F.col("call_time_seconds"))).alias("month_seconds"),
            F.max(F.when(month, F.col("note_datetime"))).alias("month_last"),
            F.max("note_datetime").alias("last_note"),
        )
    )

    def part(prefix: str) -> DataFrame:
        return talk.where(F.col(f"{prefix}_notes") > 0).select(
            "patient_id",
            F.col(f"{prefix}_seconds").alias("call_seconds"),
            F.col(f"{prefix}_last").alias("last_note"),
        )

    return replace(
        scans,
        glucose_days=materialise(scans.glucose_days),
        pressure_days=materialise(scans.pressure_days),
        intro_talk=part("intro"),
        month_talk=part("month"),
        last_notes=talk.select("patient_id", "last_note"),
    )
