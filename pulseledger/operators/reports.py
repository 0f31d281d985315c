"""Billing report, care-team dashboards and the study extract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.functions.dates import (
    Moment,
    age_years,
    between,
    moment,
    month_start,
    whole_minutes,
)
from pulseledger.operators import activity, summaries
from pulseledger.operators.joins import comparable
from pulseledger.schemas import MEDICAL_CODES

STUDY_DIAGNOSIS = "E119"
STUDY_DAYS = 16
STUDY_WINDOW_DAYS = 30


def joined_codes(necessity: DataFrame, separator: str) -> DataFrame:
    """Diagnosis codes per patient as one text, in code order, repeats kept.

    Repeats are counted before they are joined, so one patient's rows meet in a
    task only as one row per distinct code. Null codes are skipped; a patient
    with no other has a null text.
    """
    counted = necessity.groupBy("patient_id", "temp_dx_code").agg(
        F.count(F.lit(1)).cast("int").alias("times")
    )
    entry = F.when(F.col("temp_dx_code").isNotNull(), F.struct("temp_dx_code", "times"))
    listed = counted.groupBy("patient_id").agg(
        F.array_sort(F.collect_list(entry)).alias("codes")
    )

    def repeated(entry: Column) -> Column:
        code = entry["temp_dx_code"]
        more = F.repeat(F.concat(code, F.lit(separator)), entry["times"] - 1)
        return F.concat(more, code)

    text = F.array_join(F.transform("codes", repeated), separator)
    return listed.select("patient_id", F.when(F.size("codes") > 0, text).alias("dx_codes"))


def daily_codes(codes: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Codes per patient and day of service, one count column per code."""
    counts = [
        F.count_if(F.col("code") == name).alias(f"count_{name}") for name in MEDICAL_CODES
    ]
    return (
        codes.where(between(F.col("timestamp_applied"), start, end))
        .groupBy("patient_id", F.to_date("timestamp_applied").alias("date_of_service"))
        .agg(*counts)
    )


def billing_report(
    patient: DataFrame,
    address: DataFrame,
    insurance: DataFrame,
    necessity: DataFrame,
    codes: DataFrame,
    start: Moment,
    end: Moment,
    ordered: bool = True,
) -> DataFrame:
    """One line per patient and day with a code in the range.

    Patients without address, insurance or diagnosis are left out, several
    addresses or insurances repeat the line. All joins share ``patient_id``.
    """
    daily = daily_codes(codes, start, end)
    coded = necessity.join(daily.select("patient_id"), "patient_id", "left_semi")
    lines = (
        daily.join(patient, "patient_id")
        .join(address, "patient_id")
        .join(insurance, "patient_id")
        .join(joined_codes(coded, ", "), "patient_id")
    )
    if ordered:
        lines = lines.orderBy("patient_id")
    return lines.select(
        F.col("date_of_service").alias("DateOfService"),
        F.col("sharepoint_id").alias("ID"),
        F.col("first_name").alias("FirstName"),
        F.col("middle_name").alias("MiddleName"),
        F.col("last_name").alias("LastName"),
        F.col("name_suffix").alias("Suffix"),
        F.col("date_of_birth").alias("DOB"),
        F.col("phone_number").alias("PhoneNumber"),
        F.col("street_address").alias("Address"),
        F.col("city").alias("City"),
        F.col("temp_state").alias("State"),
        F.col("zipcode").alias("Zipcode"),
        F.col("sex").alias("Gender"),
        F.col("medicare_beneficiary_id").alias("MedicareNumber"),
        F.col("primary_payer_name").alias("PrimaryPayer"),
        F.col("primary_payer_id").alias("PrimaryPayerID"),
        F.col("secondary_payer_name").alias("SecondaryPayer"),
        F.col("secondary_payer_id").alias("SecondaryPayerID"),
        F.col("dx_codes").alias("DXCodes"),
        *(F.col(f"count_{name}").alias(name) for name in MEDICAL_CODES),
    )


# --- dashboards ---------------------------------------------------------------


def _month_to_date(col: Column, as_of: Moment) -> Column:
    return (col >= month_start(as_of)) & (col <= moment(as_of))


def month_minutes(patient: DataFrame, notes: DataFrame, as_of: Moment) -> DataFrame:
    """Full minutes of talk this month and the last note in it, for every patient."""
    talk = activity.talk_time(notes.where(_month_to_date(F.col("note_datetime"), as_of)))
    return patient.select("patient_id").join(talk, "patient_id", "left").select(
        "patient_id",
        whole_minutes(F.col("call_seconds")).alias("mon_min"),
        F.col("last_note").alias("last_note_date"),
    )


@dataclass(frozen=True)
class Readings:
    """Glucose and blood-pressure readings, as the dashboards read them."""

    glucose: DataFrame
    pressure: DataFrame

    def of(self, owned: DataFrame) -> Readings:
        """Those of the given devices."""
        return Readings(*(part.join(owned, "device_id", "left_semi") for part in (self.glucose, self.pressure)))

    def month_to_date(self, as_of: Moment) -> DataFrame:
        """Per device: reading days this month, and the latest reading of all time."""
        in_month = _month_to_date(F.col("received_datetime"), as_of)
        return activity.device_month(self.glucose, self.pressure, in_month)


@dataclass(frozen=True)
class SummedReadings:
    """The same from the stored summaries; no reading is read."""

    days: DataFrame
    last: DataFrame

    def of(self, owned: DataFrame) -> SummedReadings:
        return SummedReadings(*(part.join(owned, "device_id", "left_semi") for part in (self.days, self.last)))

    def month_to_date(self, as_of: Moment) -> DataFrame:
        days = summaries.window_days(self.days, month_start(as_of), moment(as_of))
        return self.last.join(days, "device_id", "left")


def month_readings(
    patient: DataFrame, device: DataFrame, readings: Readings | SummedReadings, as_of: Moment
) -> DataFrame:
    """Reading days this month and latest reading, per patient and device.

    A patient without a device has one row with no days.
    """
    per_device = readings.month_to_date(as_of)
    owned = patient.select("patient_id").join(
        device.select("patient_id", "device_id"), "patient_id", "left"
    )
    return owned.join(per_device, "device_id", "left").select(
        "patient_id",
        "device_id",
        F.coalesce("window_days", F.lit(0)).alias("mon_count"),
        "last_reading_date",
    )


def owned_devices(device: DataFrame) -> DataFrame:
    return device.groupBy("patient_id").agg(F.count("device_id").alias("owned_devices"))


def _narrowed(
    patient: DataFrame, notes: DataFrame, device: DataFrame, readings: Readings | SummedReadings
) -> tuple[DataFrame, DataFrame, Readings | SummedReadings]:
    """Notes, devices and readings cut to those of a selection of patients.

    Plain semi-joins: Spark sends the keys along or shuffles by their measured size.
    """
    chosen = patient.select("patient_id")
    device = device.join(chosen, "patient_id", "left_semi")
    return notes.join(chosen, "patient_id", "left_semi"), device, readings.of(device.select("device_id"))


def _patient_board(
    patient: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    readings: Readings | SummedReadings,
    as_of: Moment,
    narrowed: bool,
    distinct: bool,
) -> DataFrame:
    if narrowed:
        notes, device, readings = _narrowed(patient, notes, device, readings)
    minutes = month_minutes(patient, notes, as_of)
    readings = month_readings(patient, device, readings, as_of)
    board = (
        patient.join(status, "patient_id")
        .join(address, "patient_id")
        .join(minutes, "patient_id")
        .join(readings, "patient_id")
        .select(
            "patient_id",
            "first_name",
            "last_name",
            "temp_status_type",
            "temp_state",
            "mon_min",
            "last_note_date",
            "mon_count",
            "last_reading_date",
        )
    )
    return board.distinct() if distinct else board


def coach_board(
    patient: DataFrame,
    user: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    readings: Readings | SummedReadings,
    display_name: str,
    as_of: Moment,
    distinct: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """A coach's patients: talk this month, reading days and latest reading per device."""
    named = comparable(F.col("display_name"), collation) == display_name
    coach = user.where(named).select("user_id")
    coached = patient.join(coach, "user_id", "left_semi")
    return _patient_board(coached, status, address, notes, device, readings, as_of, True, distinct)


def coach_queue(
    patient: DataFrame,
    user: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    display_name: str,
    as_of: Moment,
    distinct: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """``coach_board`` over the readings themselves."""
    readings = Readings(glucose, pressure)
    return coach_board(
        patient, user, status, address, notes, device, readings, display_name, as_of, distinct, collation
    )


def search_board(
    patient: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    readings: Readings | SummedReadings,
    as_of: Moment,
    first_name: str | None = None,
    last_name: str | None = None,
    phone_number: str | None = None,
    patient_id: int | None = None,
    collation: str | None = None,
) -> DataFrame:
    """The queue's columns for the patients that match the given values.

    Values not given do not filter; the others are compared whole.
    """
    wanted = {
        "first_name": first_name,
        "last_name": last_name,
        "phone_number": phone_number,
        "patient_id": patient_id,
    }
    given = {name: value for name, value in wanted.items() if value is not None}
    for name, value in given.items():
        text = comparable(F.col(name), collation) if isinstance(value, str) else F.col(name)
        patient = patient.where(text == value)
    return _patient_board(patient, status, address, notes, device, readings, as_of, bool(given), True)


def patient_search(
    patient: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    as_of: Moment,
    **wanted,
) -> DataFrame:
    """``search_board`` over the readings themselves."""
    readings = Readings(glucose, pressure)
    return search_board(patient, status, address, notes, device, readings, as_of, **wanted)


def patient_overview(
    patient: DataFrame,
    status: DataFrame,
    address: DataFrame,
    notes: DataFrame,
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    as_of: Moment,
    patient_id: int | None = None,
) -> DataFrame:
    """Age, talk, reading days per device and owned devices; all patients or one.

    Patients without a device are left out.
    """
    in_month = _month_to_date(F.col("received_datetime"), as_of)
    readings = Readings(glucose.where(in_month), pressure.where(in_month))
    if patient_id is not None:
        patient = patient.where(F.col("patient_id") == patient_id)
        notes, device, readings = _narrowed(patient, notes, device, readings)
    readings = month_readings(patient, device, readings, as_of)
    return (
        patient.join(status, "patient_id")
        .join(address, "patient_id")
        .join(month_minutes(patient, notes, as_of), "patient_id")
        .join(readings, "patient_id")
        .join(owned_devices(device), "patient_id")
        .select(
            "patient_id",
            "full_name",
            "temp_state",
            "phone_number",
            "date_of_birth",
            age_years(F.col("date_of_birth"), as_of).alias("age"),
            "temp_status_type",
            "mon_min",
            "mon_count",
            "owned_devices",
        )
        .distinct()
    )


# --- study extract ------------------------------------------------------------


def study_reading_days(
    device: DataFrame, glucose: DataFrame, pressure: DataFrame, as_of: Moment
) -> DataFrame:
    """Distinct glucose and blood-pressure days per patient, for the study.

    A day counts when one of its readings is recent, or when the same device has
    a recent reading of the other kind.
    """
    since = moment(as_of) - F.expr(f"INTERVAL {STUDY_WINDOW_DAYS} DAYS")
    readings = activity.both_kinds(glucose, pressure, ["device_id", "received_datetime"])
    days = readings.groupBy(
        "device_id", "kind", F.to_date("received_datetime").alias("reading_day")
    ).agg((F.max("received_datetime") >= since).alias("recent"))
    # A device without any recent reading has no day that counts.
    glucose_recent = F.bool_or(F.when(F.col("kind") == "glucose", F.col("recent")))
    pressure_recent = F.bool_or(F.when(F.col("kind") == "pressure", F.col("recent")))
    devices = (
        days.groupBy("device_id")
        .agg(glucose_recent.alias("glucose_recent"), pressure_recent.alias("pressure_recent"))
        .where("glucose_recent or pressure_recent")
    )
    other = F.when(F.col("kind") == "glucose", F.col("pressure_recent")).otherwise(F.col("glucose_recent"))
    counted = days.join(devices, "device_id").where(
        F.col("reading_day").isNotNull() & (F.col("recent") | F.coalesce(other, F.lit(False)))
    )
    per_day = (
        counted.join(device.select("device_id", "patient_id"), "device_id")
        .select("patient_id", "kind", "reading_day")
        .distinct()
    )
    return (
        per_day.groupBy("patient_id")
        .agg(
            F.count_if(F.col("kind") == "glucose").alias("gr_count"),
            F.count_if(F.col("kind") == "pressure").alias("bpr_count"),
        )
        .where((F.col("gr_count") >= STUDY_DAYS) | (F.col("bpr_count") >= STUDY_DAYS))
    )


def study_extract(
    patient: DataFrame,
    address: DataFrame,
    insurance: DataFrame,
    necessity: DataFrame,
    device: DataFrame,
    glucose: DataFrame,
    pressure: DataFrame,
    as_of: Moment,
) -> DataFrame:
    """Patients with the study diagnosis and at least 16 reading days of a kind."""
    diagnosed = necessity.where(F.col("temp_dx_code") == STUDY_DIAGNOSIS)
    device = device.join(diagnosed.select("patient_id"), "patient_id", "left_semi")
    owned = device.select("device_id")
    glucose = glucose.join(owned, "device_id", "left_semi")
    pressure = pressure.join(owned, "device_id", "left_semi")
    return (
        study_reading_days(device, glucose, pressure, as_of)
        .join(joined_codes(diagnosed, ","), "patient_id")
        .join(patient, "patient_id")
        .join(address, "patient_id")
        .join(insurance, "patient_id")
        .select(
            "patient_id",
            "first_name",
            "last_name",
            "date_of_birth",
            "sex",
            "phone_number",
            "temp_state",
            "medicare_beneficiary_id",
            "dx_codes",
            "gr_count",
            "bpr_count",
        )
        .orderBy("patient_id")
    )
