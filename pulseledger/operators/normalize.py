"""Raw source frames to the names, types and values of the target tables.

Every job is one or two projections: no shuffle, no Python (but for the HTML
references in note texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.functions import cleanse
from pulseledger.functions.text import null_where


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


_US_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([AaPp][Mm])?)?\s*$"


def parsed_timestamp(col: Column) -> Column:
    """A date cell in US or ISO notation, with or without a time; anything else is null.

    The cell is matched once; its parts are then taken from one split text.
    """

    def us(parts: Column) -> Column:
        def part(place: int) -> Column:
            return F.get(parts, F.lit(place)).cast("int")

        half = F.upper(F.get(parts, F.lit(6)))
        hour = F.when(half == "", part(3)).otherwise(part(3) % 12 + F.when(half == "PM", 12).otherwise(0))
        stamp = F.try_make_timestamp_ntz(part(2), part(0), part(1), hour, part(4), part(5).cast("decimal(16,6)"))
        return F.when((part(2) > 0) & (hour < 24) & (part(4) < 60) & (part(5) < 60), stamp)

    # The one-element array binds the parts, so that they are found once. A missing
    # part of the time reads as 0: a failing cast costs more than all the rest.
    parts = F.regexp_replace(col, _US_DATE, "$1|$2|$3|0$4|0$5|0$6|$7")
    dated = F.when(col.rlike(_US_DATE), F.split(parts, "[|]"))
    stamp = F.element_at(F.transform(F.array(dated), us), 1)
    # A bare year is not a date.
    return F.coalesce(stamp, F.when(F.contains(col, F.lit("-")), col.try_cast("timestamp_ntz")))


def normalize_users(directory: DataFrame) -> DataFrame:
    """Directory members under the column names of ``user``."""
    return directory.select(
        _raw("givenName").alias("first_name"),
        _raw("surname").alias("last_name"),
        _raw("displayName").alias("display_name"),
        _raw("mail").alias("email"),
        _raw("id").alias("ms_entra_id"),
    )


def normalize_patients(export: DataFrame) -> DataFrame:
    """The whole patient export cleansed: 36 columns, one row per export row.

    Three projections: every value by itself, "nan" texts to nulls, then the
    values derived from several. The relationship is read from the contact's
    name before that is cleaned.
    """
    cleansed = export.select(
        cleanse.name(_raw("First Name"), cleanse.PERSON_NAME_DROPS).alias("first_name"),
        cleanse.name(_raw("Last Name"), cleanse.PERSON_NAME_DROPS).alias("last_name"),
        cleanse.name(_raw("Middle Name"), cleanse.MIDDLE_NAME_DROPS).alias("middle_name"),
        cleanse.short_title(_raw("Suffix")).alias("name_suffix"),
        cleanse.short_title(_raw("Nickname")).alias("nick_name"),
        _timestamp(export, "DOB").alias("date_of_birth"),
        cleanse.sex(_raw("Gender")).alias("sex"),
        cleanse.email(_raw("Email")).alias("email"),
        cleanse.digits_only(_raw("Phone Number")).alias("phone_number"),
        cleanse.digits_only(_raw("Social Security")).alias("social_security"),
        cleanse.race(_raw("Race")).alias("temp_race"),
        _raw("Relationship_Status").alias("temp_marital_status"),
        _raw("Preferred_Language").alias("preferred_language"),
        cleanse.weight_lbs(_raw("Weight")).alias("weight_lbs"),
        cleanse.height_in(_raw("Height")).alias("height_in"),
        _raw("ID").try_cast("bigint").alias("sharepoint_id"),
        cleanse.name(_raw("Mailing Address"), cleanse.STREET_DROPS).alias("street_address"),
        cleanse.name(_raw("City"), cleanse.CITY_DROPS).alias("city"),
        cleanse.state(_raw("State")).alias("temp_state"),
        cleanse.zip_base(_raw("Zip code")).alias("zipcode"),
        cleanse.name(_raw("EmergencyName"), cleanse.CONTACT_NAME_DROPS).alias("emergency_full_name"),
        cleanse.digits_only(_raw("EmergencyNumber")).alias("emergency_phone_number"),
        cleanse.relationship(_raw("EmergencyName")).alias("emergency_relationship"),
        cleanse.name(_raw("EmergencyName2"), cleanse.CONTACT_NAME_DROPS).alias("emergency_full_name2"),
        cleanse.digits_only(_raw("EmergencyNumber2")).alias("emergency_phone_number2"),
        cleanse.relationship(_raw("EmergencyName2")).alias("emergency_relationship2"),
        cleanse.beneficiary_id(_raw("Medicare ID number")).alias("medicare_beneficiary_id"),
        cleanse.insurer(_raw("Insurance Name:")).alias("payer"),
        cleanse.insurance_id(_raw("Insurance ID:")).alias("payer_id"),
        cleanse.insurance_id(_raw("InsuranceID2")).alias("secondary_payer_id"),
        cleanse.insurer(_raw("InsuranceName2")).alias("secondary_payer_name"),
        _timestamp(export, "On-board Date").alias("evaluation_datetime"),
        cleanse.diagnosis_codes(_raw("DX_Code")).alias("temp_dx_code"),
        cleanse.member_status(_raw("Member_Status")).alias("temp_status_type"),
        _raw("Health Coach").alias("temp_user"),
    )
    paid_by = cleanse.primary_payer(
        F.col("payer"), F.col("payer_id"), F.col("medicare_beneficiary_id")
    )
    return null_where(cleansed, cleanse.NAN_TEXT).withColumns(
        {
            "full_name": cleanse.full_name(F.col("first_name"), F.col("last_name")),
            "primary_payer_name": paid_by,
            "primary_payer_id": cleanse.primary_payer_id(
                paid_by, F.col("payer_id"), F.col("medicare_beneficiary_id")
            ),
        }
    ).drop("payer", "payer_id")


def _timestamp(df: DataFrame, name: str) -> Column:
    """A date column as it is when already typed, parsed when it is text."""
    kind = dict(df.dtypes)[name]
    return parsed_timestamp(_raw(name)) if kind == "string" else _raw(name).cast("timestamp_ntz")


def merge_notes(notes_log: DataFrame, time_log: DataFrame) -> DataFrame:
    """Notes with the call time logged for them.

    A left join on patient, note and author, null keys matching null keys; a
    note with several log rows appears once per log row. The log's own note
    fills a missing note type. Call time is converted before the join, so a note
    without a log row keeps a null call time.
    """
    keys = ("SharePoint_ID", "Note_ID", "LCH_UPN")
    log = time_log.select(
        F.col("SharPoint_ID").alias("log_SharePoint_ID"),
        F.col("Note_ID").alias("log_Note_ID"),
        F.col("LCH_UPN").alias("log_LCH_UPN"),
        cleanse.call_seconds(F.col("Recording_Time")).alias("Recording_Time"),
        F.col("Notes").alias("Note_Type"),
        "Auto_Time",
        "Start_Time",
        "End_Time",
    )
    same = None
    for key in keys:
        equal = F.col(key).eqNullSafe(F.col(f"log_{key}"))
        same = equal if same is None else same & equal
    merged = notes_log.join(log, same, "left")
    return merged.select(
        "SharePoint_ID",
        "Notes",
        "TimeStamp",
        "LCH_UPN",
        F.coalesce("Time_Note", "Note_Type").alias("Time_Note"),
        "Recording_Time",
        "Auto_Time",
        "Start_Time",
        "End_Time",
    )


def normalize_patient_notes(notes: DataFrame) -> DataFrame:
    """Merged notes as ``patient_note`` rows (call time already in seconds)."""
    author = F.col("LCH_UPN")
    cleansed = notes.select(
        cleanse.whole_number(F.col("SharePoint_ID")).alias("sharepoint_id"),
        cleanse.plain_text(F.col("Notes")).alias("note_content"),
        F.col("TimeStamp").alias("note_datetime"),
        author.alias("temp_user"),
        cleanse.staff_note_type(author, cleanse.note_type(F.col("Time_Note"))).alias("temp_note_type"),
        cleanse.staff_call_seconds(author, F.col("Recording_Time"))
        .try_cast("bigint")
        .alias("call_time_seconds"),
        cleanse.flag(F.col("Auto_Time"), inverted=True).alias("is_manual"),
        F.col("Start_Time").alias("start_call_datetime"),
        F.col("End_Time").alias("end_call_datetime"),
    )
    return null_where(cleansed, cleanse.NA_TEXT)


def normalize_devices(fulfillment: DataFrame) -> DataFrame:
    return fulfillment.select(
        cleanse.vendor(F.col("Vendor"), F.col("Device_Name")).alias("Vendor"),
        cleanse.device_code(F.col("Device_ID")).alias("hardware_uuid"),
        F.col("Device_Name").alias("name"),
        F.col("Patient_ID").try_cast("bigint").alias("sharepoint_id"),
    )


def _reading_columns() -> list[Column]:
    return [
        F.col("SharePoint_ID").try_cast("bigint").alias("sharepoint_id"),
        F.col("Device_Model").alias("temp_device"),
        F.col("Time_Recorded").alias("recorded_datetime"),
        F.col("Time_Recieved").alias("received_datetime"),
    ]


def normalize_bp_readings(pressure_log: DataFrame) -> DataFrame:
    return pressure_log.select(
        *_reading_columns(),
        cleanse.two_decimals(F.col("BP_Reading_Systolic")).alias("systolic_reading"),
        cleanse.two_decimals(F.col("BP_Reading_Diastolic")).alias("diastolic_reading"),
        cleanse.flag(F.col("Manual_Reading")).alias("is_manual"),
    )


def normalize_bg_readings(glucose_log: DataFrame) -> DataFrame:
    return glucose_log.select(
        *_reading_columns(),
        cleanse.two_decimals(F.col("BG_Reading")).alias("glucose_reading"),
        cleanse.flag(F.col("Manual_Reading")).alias("is_manual"),
    )
