"""Column lists and types of every source and target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- sources ------------------------------------------------------------------

# Raw patient export; every cell is read as text.
PATIENT_EXPORT_COLUMNS: tuple[str, ...] = (
    "ID",
    "First Name",
    "Last Name",
    "Middle Name",
    "Nickname",
    "Suffix",
    "DOB",
    "On-board Date",
    "Gender",
    "Email",
    "Race",
    "Relationship_Status",
    "Preferred_Language",
    "Phone Number",
    "Social Security",
    "Zip code",
    "Weight",
    "Height",
    "Mailing Address",
    "City",
    "State",
    "EmergencyName",
    "EmergencyNumber",
    "EmergencyName2",
    "EmergencyNumber2",
    "Medicare ID number",
    "DX_Code",
    "Insurance Name:",
    "Insurance ID:",
    "InsuranceName2",
    "InsuranceID2",
    "Member_Status",
    "Health Coach",
)

SOURCES: dict[str, str] = {
    "directory": (
        "value array<struct<givenName string, surname string, displayName string, "
        "mail string, id string>>"
    ),
    "notes_log": (
        "SharePoint_ID bigint, Notes string, TimeStamp timestamp_ntz, LCH_UPN string, "
        "Time_Note string, Note_ID bigint"
    ),
    "time_log": (
        "SharPoint_ID bigint, Recording_Time string, LCH_UPN string, Notes string, "
        "Auto_Time boolean, Start_Time timestamp_ntz, End_Time timestamp_ntz, Note_ID bigint"
    ),
    "fulfillment": (
        "Vendor string, Device_ID string, Device_Name string, Patient_ID bigint, Resupply boolean"
    ),
    "glucose_log": (
        "SharePoint_ID bigint, Device_Model string, Time_Recorded timestamp_ntz, "
        "Time_Recieved timestamp_ntz, BG_Reading string, Manual_Reading boolean"
    ),
    "pressure_log": (
        "SharePoint_ID bigint, Device_Model string, Time_Recorded timestamp_ntz, "
        "Time_Recieved timestamp_ntz, BP_Reading_Systolic string, BP_Reading_Diastolic string, "
        "Manual_Reading boolean"
    ),
}

# --- targets ------------------------------------------------------------------

TARGETS: dict[str, str] = {
    "user": (
        "user_id bigint, first_name string, last_name string, display_name string, "
        "email string, ms_entra_id string"
    ),
    "patient": (
        "patient_id bigint, first_name string, last_name string, middle_name string, "
        "name_suffix string, full_name string, nick_name string, date_of_birth timestamp_ntz, "
        "sex string, email string, phone_number string, social_security string, "
        "temp_race string, temp_marital_status string, preferred_language string, "
        "weight_lbs bigint, height_in bigint, sharepoint_id bigint, temp_user string, "
        "user_id bigint"
    ),
    "patient_address": (
        "patient_id bigint, street_address string, city string, temp_state string, zipcode string"
    ),
    "patient_insurance": (
        "patient_id bigint, medicare_beneficiary_id string, primary_payer_id string, "
        "primary_payer_name string, secondary_payer_id string, secondary_payer_name string"
    ),
    "medical_necessity": (
        "patient_id bigint, evaluation_datetime timestamp_ntz, temp_dx_code string"
    ),
    "patient_status": (
        "patient_id bigint, temp_status_type string, modified_date timestamp_ntz, "
        "temp_user string, patient_status_type_id bigint"
    ),
    "emergency_contact": (
        "patient_id bigint, full_name string, phone_number string, relationship string"
    ),
    "device": "device_id bigint, hardware_uuid string, name string, patient_id bigint, vendor_id bigint",
    "glucose_reading": (
        "device_id bigint, temp_device string, recorded_datetime timestamp_ntz, "
        "received_datetime timestamp_ntz, glucose_reading double, is_manual int"
    ),
    "blood_pressure_reading": (
        "device_id bigint, temp_device string, recorded_datetime timestamp_ntz, "
        "received_datetime timestamp_ntz, systolic_reading double, diastolic_reading double, "
        "is_manual int"
    ),
    "patient_note": (
        "patient_id bigint, note_content string, note_datetime timestamp_ntz, temp_user string, "
        "temp_note_type string, call_time_seconds bigint, is_manual int, "
        "start_call_datetime timestamp_ntz, end_call_datetime timestamp_ntz, "
        "note_type_id bigint, user_id bigint"
    ),
    "medical_code": (
        "med_code_id bigint, patient_id bigint, med_code_type_id bigint, "
        "timestamp_applied timestamp_ntz"
    ),
    "medical_code_device": "med_code_id bigint, device_id bigint",
}

# Summaries of the readings and notes, added to by every load. A device and day (a patient, type
# and day) may have one row per load; ``device_last_reading`` has one row per device.
SUMMARIES: dict[str, str] = {
    "reading_day": (
        "device_id bigint, kind string, reading_day date, first_reading timestamp_ntz, "
        "last_reading timestamp_ntz"
    ),
    "device_last_reading": "device_id bigint, last_reading_date timestamp_ntz",
    "talk_day": (
        "patient_id bigint, note_type_id bigint, note_day date, call_seconds bigint, "
        "last_note timestamp_ntz"
    ),
}

# Tables stored by month, and the column the month is of (their readers filter on it).
MONTH_OF: dict[str, str] = {
    "glucose_reading": "received_datetime",
    "blood_pressure_reading": "received_datetime",
    "patient_note": "note_datetime",
    "reading_day": "reading_day",
    "talk_day": "note_day",
}

CODE_TABLES: tuple[str, ...] = ("medical_code_device", "medical_code")

# Seeded lookup tables: the code names the rules apply, and the note types they read.
MEDICAL_CODES: tuple[str, ...] = ("99202", "99453", "99454", "99457", "99458")
NOTE_TYPES: tuple[str, ...] = ("Initial Evaluation", "Follow-up", "Alert")
VENDORS: tuple[str, ...] = ("Tenovi", "Omron")
STATUS_TYPES: tuple[str, ...] = ("Active", "Do Not Call", "Inactive", "Onboard")


def target_columns(table: str) -> dict[str, str]:
    """Names and types of a target table, without a session."""
    return dict(column.split(" ") for column in TARGETS[table].split(", "))


def stored_columns(table: str) -> str:
    """Columns of a target or summary table."""
    return TARGETS[table] if table in TARGETS else SUMMARIES[table]


def target_schema(table: str) -> StructType:
    return StructType.fromDDL(stored_columns(table))


def empty_frame(spark: SparkSession, ddl: str) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty."""
    columns = [
        F.lit(None).cast(field.dataType).alias(field.name) for field in StructType.fromDDL(ddl)
    ]
    return spark.range(1).where(F.lit(False)).select(*columns)


def lookup_frame(spark: SparkSession, id_column: str, names: tuple[str, ...]) -> DataFrame:
    """A small seeded table: ids 1..n in the order of ``names``."""
    listed = F.array(*(F.lit(name) for name in names))
    return spark.range(1).select(F.posexplode(listed).alias("position", "name")).select(
        (F.col("position") + 1).cast("bigint").alias(id_column), "name"
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Order and type the columns as the target table has them; absent ones are null."""
    present = set(df.columns)

    def column(field) -> Column:
        source = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*(column(field) for field in target_schema(table)))
