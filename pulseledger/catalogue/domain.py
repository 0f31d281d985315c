"""The given tables read as patient-monitoring tables.

Each table is a projection of one given table. The expressions are written so
that Spark SQL and DuckDB read them alike: the queries use them as DataFrames,
the SQL checks as common table expressions. Only these input mappings are
shared; what is computed from them is written twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger import schemas
from pulseledger.sources.readers import in_even_pieces

AS_OF = "2024-02-09"
DASHBOARD_TIME = "2024-01-20 15:30:00"
REPORT_START, REPORT_END = "2024-01-01", "2024-01-30"
LOADED_AT = "2024-02-01 08:00:00"


@dataclass(frozen=True)
class Mapping:
    source: str
    columns: dict[str, str]
    where: str = "TRUE"
    copies: int = 1  # every source row this often, numbered 0, 1, ... in ``copy``

    def frame(self, given: DataFrame) -> DataFrame:
        if self.copies > 1:
            numbers = F.array(*(F.lit(n) for n in range(self.copies)))
            given = given.select("*", F.explode(numbers).alias("copy"))
        rows = given if self.where == "TRUE" else given.where(self.where)
        return rows.selectExpr(
            *(
                f"{text.replace('{TS}', 'TIMESTAMP_NTZ')} AS `{name}`"
                for name, text in self.columns.items()
            )
        )

    def sql(self) -> str:
        columns = ", ".join(
            f'{text.replace("{TS}", "TIMESTAMP")} AS "{name}"' for name, text in self.columns.items()
        )
        source = self.source
        if self.copies > 1:
            numbers = ", ".join(f"({n})" for n in range(self.copies))
            source += f" CROSS JOIN (VALUES {numbers}) AS copies(copy)"
        return f"SELECT {columns} FROM {source} WHERE {self.where}"


def _cycle(key: str, *values: str | None) -> str:
    """One of the literal texts, by ``key`` modulo their number."""
    quoted = [
        "NULL" if value is None else "'" + value.replace("'", "''") + "'" for value in values
    ]
    arms = " ".join(f"WHEN {n} THEN {text}" for n, text in enumerate(quoted))
    return f"CASE {key} % {len(values)} {arms} END"


def _padded(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS STRING), {width}, '0')"


CUSTOMER = "c_custkey"

# --- target tables ------------------------------------------------------------

TARGET_MAPPINGS: dict[str, Mapping] = {
    "patient": Mapping(
        "customer",
        {
            "patient_id": CUSTOMER,
            "sharepoint_id": f"{CUSTOMER} + 100000",
            "user_id": "CAST(c_nationkey AS BIGINT)",
            "first_name": _cycle(CUSTOMER, "Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gus"),
            "middle_name": _cycle(CUSTOMER, "Lee", None, "Ray", None),
            "last_name": _cycle(CUSTOMER, "Smith", "Jones", "O'Brien", "Lopez", "Chen"),
            "name_suffix": _cycle(CUSTOMER, None, "Jr", None),
            "full_name": "c_name",
            "date_of_birth": f"CAST(DATE '1930-01-01' + CAST(({CUSTOMER} * 37) % 20000 AS INT) AS {{TS}})",
            "sex": _cycle(CUSTOMER, "M", "F"),
            # Neighbours share ten digits; every second number has an eleventh.
            "phone_number": (
                f"'555' || {_padded(f'(({CUSTOMER} - {CUSTOMER} % 2) * 7919) % 10000000', 7)} "
                f"|| CASE WHEN {CUSTOMER} % 2 = 1 THEN '1' ELSE '' END"
            ),
            "temp_user": f"'NATION_' || CAST(({CUSTOMER} * 3) % 29 AS STRING)",
        },
    ),
    "user": Mapping(
        "nation", {"user_id": "CAST(n_nationkey AS BIGINT)", "display_name": "n_name"}
    ),
    "patient_address": Mapping(
        "customer",
        {
            "patient_id": CUSTOMER,
            "street_address": f"CAST({CUSTOMER} % 9000 + 1 AS STRING) || ' Main St'",
            "city": _cycle(CUSTOMER, "Anytown", "Springfield", "Rivertown"),
            "temp_state": _cycle("c_nationkey", "CA", "TX", "NY", "FL", "WV"),
            "zipcode": _padded(f"({CUSTOMER} * 31) % 100000", 5),
        },
    ),
    "patient_insurance": Mapping(
        "customer",
        {
            "patient_id": CUSTOMER,
            "medicare_beneficiary_id": f"'1EG4TE5' || {_padded(f'{CUSTOMER} % 10000', 4)}",
            "primary_payer_name": "c_mktsegment",
            "primary_payer_id": f"'P' || {_padded(CUSTOMER, 8)}",
            "secondary_payer_name": _cycle(CUSTOMER, None, "Humana", None, "Cigna"),
            "secondary_payer_id": _cycle(CUSTOMER, None, "H123", None, "C456"),
        },
    ),
    "patient_status": Mapping(
        "customer",
        {
            "patient_id": CUSTOMER,
            "temp_status_type": _cycle(CUSTOMER, "Active", "Onboard", "Inactive", "Paused", None),
        },
    ),
    "medical_necessity": Mapping(
        "orders",
        {
            "patient_id": "o_custkey",
            "evaluation_datetime": "o_orderdate",
            "temp_dx_code": (
                "CASE o_orderpriority WHEN '1-URGENT' THEN 'E119' WHEN '2-HIGH' THEN 'I10' "
                "WHEN '3-MEDIUM' THEN 'E785' WHEN '4-NOT SPECIFIED' THEN 'R05' ELSE 'I509' END"
            ),
        },
    ),
    "glucose_reading": Mapping(
        "events",
        {
            "device_id": "user_id * 2",
            "received_datetime": "ts",
            "glucose_reading": "value",
        },
        "event_type IN ('view', 'click', 'error')",
    ),
    "blood_pressure_reading": Mapping(
        "events",
        {
            "device_id": "user_id * 2 + 1",
            "received_datetime": "ts",
            "systolic_reading": "value",
        },
        "event_type IN ('purchase', 'error', 'click')",
    ),
    # Both kinds of reading on one device, for the rules that look at either.
    "pressure_on_same_device": Mapping(
        "events",
        {
            "device_id": "user_id * 2",
            "received_datetime": (
                "CASE WHEN user_id % 2 = 0 OR ts < TIMESTAMP_NTZ '2024-01-08 00:00:00' THEN ts END"
            ),
        },
        "event_type = 'purchase'",
    ),
    "patient_note": Mapping(
        "events",
        {
            "patient_id": "user_id",
            "note_datetime": "ts",
            "call_time_seconds": "CAST(floor(value * 10) AS BIGINT)",
            "note_type_id": "event_id % 3 + 1",
        },
        "event_type = 'signup'",
    ),
}

# --- raw sources ----------------------------------------------------------------

_MONTH, _DAY, _YEAR = f"{CUSTOMER} % 12 + 1", f"{CUSTOMER} % 28 + 1", f"{CUSTOMER} % 60 + 1930"
_ISO_BIRTH = f"CAST({_YEAR} AS STRING) || '-' || {_padded(_MONTH, 2)} || '-' || {_padded(_DAY, 2)}"
_US_BIRTH = (
    f"CAST({_MONTH} AS STRING) || '/' || CAST({_DAY} AS STRING) || '/' || CAST({_YEAR} AS STRING)"
)
_LAST_FOUR = _padded(f"{CUSTOMER} % 10000", 4)
_AUTHOR = _cycle(
    "event_id",
    "CoachA",
    "NursePractitioner",
    "CoachB",
    "RegisteredNurse2",
    "AlertTeamMember4",
    "NATION_7",
    None,
)
_RECORDED = (
    f"CAST(event_id % 2 AS STRING) || ':' || {_padded('event_id % 60', 2)} || ':' || "
    + _padded("(event_id * 7 + copy * 11) % 60", 2)
)
_NOTE_ID = "CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id END"

RAW_MAPPINGS: dict[str, Mapping] = {
    "patient_export": Mapping(
        "customer",
        {
            "ID": f"CAST({CUSTOMER} + 100000 AS STRING)",
            "First Name": f"CASE WHEN {CUSTOMER} % 9 = 8 THEN c_name ELSE "
            + _cycle(f"({CUSTOMER} % 9)", "  john ", "MARY   ann", "o'brien", "lee-ann (jr)", None,
                     "x1y2z", "nan", "a. b.", "")
            + " END",
            "Last Name": _cycle(CUSTOMER, "doe", "  van der BERG ", "smith-jones", "mc.donald 3", None, "NAN"),
            "Middle Name": _cycle(CUSTOMER, "a.", None, "lee", "  anna-MARIA ", "nan"),
            "Nickname": _cycle(CUSTOMER, None, " johnny b", "MISS  piggy", "nan"),
            "Suffix": _cycle(CUSTOMER, None, None, "jr", " III ", "sr."),
            "DOB": f"CASE WHEN {CUSTOMER} % 11 = 0 THEN NULL WHEN {CUSTOMER} % 2 = 0 "
            f"THEN {_ISO_BIRTH} ELSE {_US_BIRTH} END",
            "On-board Date": f"'2023-' || {_padded(_MONTH, 2)} || '-' || {_padded(_DAY, 2)}",
            "Gender": _cycle(CUSTOMER, "Male", "Female", "female", None, "Other"),
            "Email": f"CASE {CUSTOMER} % 4 WHEN 0 THEN ' USER' || CAST({CUSTOMER} AS STRING) || "
            "'@EXAMPLE.COM ' WHEN 1 THEN 'invalid-email' WHEN 2 THEN NULL "
            f"ELSE 'first.last+tag@mail.example.org' END",
            "Race": _cycle(CUSTOMER, "white", "African  AMERICAN", "black/white", "native american",
                           "alaska native", "unknown", None, "latin", "native hawaiian", "asian-indian"),
            "Relationship_Status": _cycle(CUSTOMER, "Married", "Single", None, "nan"),
            "Preferred_Language": _cycle(CUSTOMER, "English", "Spanish", "NaN"),
            "Phone Number": f"CASE {CUSTOMER} % 6 WHEN 0 THEN '123-456-' || {_LAST_FOUR} "
            f"WHEN 1 THEN '+1 (555) 010-' || {_LAST_FOUR} WHEN 2 THEN NULL WHEN 3 THEN 'call me' "
            f"WHEN 4 THEN '1.555.020.' || {_LAST_FOUR} ELSE '0015550300' || {_LAST_FOUR} END",
            "Social Security": f"CASE {CUSTOMER} % 5 WHEN 0 THEN NULL WHEN 1 THEN '1234567890' "
            f"ELSE '123-45-' || {_LAST_FOUR} END",
            "Zip code": f"CASE {CUSTOMER} % 5 WHEN 0 THEN '12345-6789' WHEN 1 THEN NULL "
            f"WHEN 2 THEN '123456' ELSE {_padded(f'{CUSTOMER} % 100000', 5)} END",
            "Weight": _cycle(CUSTOMER, "150 lbs", "95.0", None, "5'8\"", "invalid-weight", "2000",
                             "", "abc", "180", " 99 kg"),
            "Height": _cycle(CUSTOMER, "5'8\"", "68", "5 ft 10 in", "150 lbs", None, "6'", "5 8 9",
                             "tall", "5ft", " 4'11 "),
            "Mailing Address": _cycle(CUSTOMER, "123 main st", " 45-b OAK ave., apt #2/3 ", None,
                                      "po box 9 (rear)", "7  pine;rd"),
            "City": _cycle(CUSTOMER, "new york", "Winston-salem", " st. LOUIS ", None, "anytown"),
            "State": _cycle(CUSTOMER, "california", " New York", "west virginia", "tx",
                            "invalid-state", None, "Arkansas", "district of columbia",
                            "FLORIDA (fl)", "kansas", "northern mariana islands"),
            "EmergencyName": _cycle(CUSTOMER, "jane doe (wife)", "son: bob", None, "grandson tim",
                                    "MOTHER/father", "alice jones-smith", "nan"),
            "EmergencyNumber": _cycle(CUSTOMER, "123-456-7890", None, "n0ne", "1 234 567 8901",
                                      "123456789012"),
            "EmergencyName2": _cycle(CUSTOMER, None, "best friend", None, "care giver", "caregiver",
                                     None),
            "EmergencyNumber2": _cycle(CUSTOMER, None, "456-789-0123", "", "789"),
            "Medicare ID number": f"CASE {CUSTOMER} % 6 WHEN 0 THEN '1eg4-te5-mk' || "
            f"{_padded(f'{CUSTOMER} % 100', 2)} WHEN 1 THEN 'short-id' WHEN 2 THEN NULL "
            f"WHEN 3 THEN ' 3CD5 UF6 LM84 extra' WHEN 4 THEN 'nan' ELSE '2AB4CD5EF' || "
            f"{_padded(f'{CUSTOMER} % 100', 2)} END",
            "DX_Code": _cycle(CUSTOMER, "E11.9,I10", "i10; e78.5", "", None, "none", "|10 R05",
                              "E11.65 and R73.03, I50.9", "E119"),
            "Insurance Name:": _cycle(CUSTOMER, "kaiser health plan", None, "BCBS federal",
                                      "blue  shield of x", "anthem", "unknown insurance co",
                                      "United HealthCare", "united american", "medicaid of ca", "nan",
                                      "aarp/uhc", "champ (va)", "american-continental"),
            "Insurance ID:": f"CASE {CUSTOMER} % 7 WHEN 0 THEN ' abc-123-xyz ' WHEN 1 THEN NULL "
            "WHEN 2 THEN 'invalid-id' WHEN 3 THEN '12ab34cd56ef78gh90ij' WHEN 4 THEN '---' "
            f"WHEN 5 THEN 'W' || {_padded(CUSTOMER, 9)} ELSE '1234567890123456789012345678901234567890' END",
            "InsuranceName2": _cycle(CUSTOMER, "Medicaid", None, None, "mutual of OMAHA", "humanna gold"),
            "InsuranceID2": _cycle(CUSTOMER, None, "ghi-789-rst", None, "h 1 2 3", "nan", "A1B2C3D4E5"),
            "Member_Status": _cycle(CUSTOMER, "Active", "On-Board", "In-Active", "DO NOT CALL", None, "Paused"),
            "Health Coach": f"'NATION_' || CAST({CUSTOMER} % 27 AS STRING)",
        },
    ),
    "directory": Mapping(
        "nation",
        {
            "givenName": "substr(n_name, 1, 6)",
            "surname": "substr(n_name, 8)",
            "displayName": "n_name",
            "mail": "lower(n_name) || '@example.org'",
            "id": "'entra-' || " + _padded("n_nationkey", 4),
        },
    ),
    "fulfillment": Mapping(
        "customer",
        {
            "Vendor": _cycle(CUSTOMER, "Tenovi", "Omron", "Other", "Omron", "Tenovi"),
            "Device_ID": f"'ab-' || {_padded(CUSTOMER, 6)} || '-' || {_padded(f'{CUSTOMER} % 97', 2)}",
            "Device_Name": _cycle(CUSTOMER, "Tenovi Glucometer", "Omron BP Monitor",
                                  "Tenovi Cellular BPM", "Scale X", None, "omron mini"),
            "Patient_ID": f"{CUSTOMER} - {CUSTOMER} % 2 + 100000",
            "Resupply": f"{CUSTOMER} % 7 = 0",
        },
    ),
    "glucose_log": Mapping(
        "events",
        {
            "SharePoint_ID": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id + 100000 END",
            "Device_Model": _cycle("event_id", "GM-1", "GM-2", None),
            "Time_Recorded": "ts",
            "Time_Recieved": "ts + INTERVAL '5' MINUTE",
            "BG_Reading": "CAST(value AS STRING) || '5'",
            "Manual_Reading": "event_id % 2 = 0",
        },
        "event_type IN ('view', 'click', 'error')",
    ),
    "pressure_log": Mapping(
        "events",
        {
            "SharePoint_ID": "user_id + 100000",
            "Device_Model": _cycle("event_id", "BP-1", None),
            "Time_Recorded": "ts",
            "Time_Recieved": "ts + INTERVAL '2' MINUTE",
            "BP_Reading_Systolic": "CAST(value AS STRING)",
            "BP_Reading_Diastolic": "'7' || CAST(value AS STRING) || '25'",
            "Manual_Reading": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id % 2 = 1 END",
        },
        "event_type IN ('purchase', 'error', 'click')",
    ),
    "notes_log": Mapping(
        "events",
        {
            "SharePoint_ID": "user_id + 100000",
            "Notes": "CASE WHEN event_id % 13 = 0 THEN 'NA' WHEN event_id % 17 = 0 THEN NULL "
            "ELSE '<p class=\"n\">' || props || '</p> a &lt;b&gt;b&lt;/b&gt; &amp; <br/>ok' END",
            "TimeStamp": "ts",
            "LCH_UPN": _AUTHOR,
            "Time_Note": _cycle("event_id", "Initial Evaluation with APRN", None, "Follow-up, Check-up",
                                "Alert", "nan"),
            "Note_ID": _NOTE_ID,
        },
        "event_type = 'signup'",
    ),
    "time_log": Mapping(
        "events",
        {
            "SharPoint_ID": "user_id + 100000",
            "Recording_Time": f"CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '1 days ' || "
            f"{_RECORDED} ELSE {_RECORDED} END",
            "LCH_UPN": _AUTHOR,
            "Notes": _cycle("event_id", "Follow-up", "Initial Evaluation, Alert", None),
            "Auto_Time": "event_id % 3 = 0",
            "Start_Time": "ts - INTERVAL '10' MINUTE",
            "End_Time": "ts",
            "Note_ID": _NOTE_ID,
        },
        # No log for some notes, two rows for others.
        "event_type = 'signup' AND event_id % 4 <> 1 AND (copy = 0 OR event_id % 5 = 0)",
        copies=2,
    ),
}

# Sources whose rows take a hundred times longer to cleanse than to read.
COSTLY_SOURCES = ("patient_export",)

DEVICE_SQL = (
    "SELECT c_custkey * 2 AS device_id, c_custkey AS patient_id FROM customer WHERE c_custkey % 3 <> 0 "
    "UNION ALL "
    "SELECT c_custkey * 2 + 1, c_custkey FROM customer WHERE c_custkey % 3 <> 1"
)


def device_frame(customer: DataFrame) -> DataFrame:
    """A glucose device (even id) and a blood-pressure device (odd id) for most patients."""
    slots = customer.select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("slot"))
    return slots.where(F.col("c_custkey") % 3 != F.col("slot")).select(
        (F.col("c_custkey") * 2 + F.col("slot")).alias("device_id"),
        F.col("c_custkey").alias("patient_id"),
    )


def _lookup_sql(id_column: str, names: tuple[str, ...]) -> str:
    rows = ", ".join(f"({n}, '{name}')" for n, name in enumerate(names, start=1))
    return f"SELECT CAST(id AS BIGINT) AS {id_column}, name FROM (VALUES {rows}) AS listed(id, name)"


LOOKUPS: dict[str, tuple[str, tuple[str, ...]]] = {
    "note_type": ("note_type_id", schemas.NOTE_TYPES),
    "medical_code_type": ("med_code_type_id", schemas.MEDICAL_CODES),
    "patient_status_type": ("patient_status_type_id", schemas.STATUS_TYPES),
    "vendor": ("vendor_id", schemas.VENDORS),
}


class Domain:
    """The mapped tables of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def given(self, table: str) -> DataFrame:
        if table not in self._given:
            self._given[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._given[table]

    def __getitem__(self, table: str) -> DataFrame:
        if table in LOOKUPS:
            return schemas.lookup_frame(self.spark, *LOOKUPS[table])
        if table == "device":
            return device_frame(self.given("customer"))
        return self._mapped(TARGET_MAPPINGS[table])

    def raw(self, source: str) -> DataFrame:
        mapping = RAW_MAPPINGS[source]
        if source in COSTLY_SOURCES:
            return mapping.frame(in_even_pieces(self.given(mapping.source)))
        return self._mapped(mapping)

    def _mapped(self, mapping: Mapping) -> DataFrame:
        return mapping.frame(self.given(mapping.source))


def table_sql(table: str) -> str:
    """The mapped table as a DuckDB query."""
    if table in LOOKUPS:
        return _lookup_sql(*LOOKUPS[table])
    if table == "device":
        return DEVICE_SQL
    mapping = TARGET_MAPPINGS.get(table) or RAW_MAPPINGS[table]
    return mapping.sql().replace("TIMESTAMP_NTZ", "TIMESTAMP")
