"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger.catalogue.domain import (
    AS_OF,
    DASHBOARD_TIME,
    LOADED_AT,
    REPORT_END,
    REPORT_START,
    Domain,
)
from pulseledger.functions import cleanse
from pulseledger.functions.dates import last_billing_cycle, moment
from pulseledger.operators import activity, codes, entities, keys, normalize, quality, reports
from pulseledger.plans import billing, dashboards, load, month
from pulseledger.schemas import CODE_TABLES, MEDICAL_CODES, MONTH_OF, TARGETS
from pulseledger.session import materialise, shared_folder
from pulseledger.sources import readers, versions, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

COACH = "NATION_3"
ONE_PATIENT = 5
LONG_PHONE = "55500158381"
CODE_COLUMNS = MEDICAL_CODES
ANY_CASE = "UTF8_LCASE_RTRIM"
FIRST_RUN = "2024-01-20"
OPEN_REPORT_START = "2024-01-15"
# Stored before the readings and notes are added.
STORED_TABLES = (
    "user",
    "patient",
    "patient_address",
    "patient_insurance",
    "medical_necessity",
    "patient_status",
    "device",
)
SCAN_START, SCAN_END = "2024-01-05", "2024-01-25"


def _query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Domain(spark, sf_dir))
    return build


def _code_rows(df: DataFrame) -> DataFrame:
    return df.select("patient_id", "code", "timestamp_applied")


def _single_rule(d: Domain, rule: codes.Rule, *before: codes.Step) -> DataFrame:
    """A rule on its own, after the rules it depends on."""
    act = billing.scanned_activity(d, AS_OF)
    state = codes.apply_rules(act, codes.CodeState.empty(d.spark), AS_OF, [before] if before else [])
    return _code_rows(rule(act, state, AS_OF))


# --- billing codes ----------------------------------------------------------------


@_query
def code_99202(d: Domain) -> DataFrame:
    return _single_rule(d, codes.first_visit)


@_query
def code_99453_glucose(d: Domain) -> DataFrame:
    return _single_rule(d, codes.glucose_setup)


@_query
def code_99453_bp(d: Domain) -> DataFrame:
    return _single_rule(d, codes.pressure_setup, codes.Step("glucose_setup", codes.glucose_setup, True))


@_query
def code_99454_glucose(d: Domain) -> DataFrame:
    return _single_rule(d, codes.glucose_usage)


@_query
def code_99454_bp(d: Domain) -> DataFrame:
    return _single_rule(d, codes.pressure_usage, codes.Step("glucose_usage", codes.glucose_usage))


@_query
def code_99454_combined(d: Domain) -> DataFrame:
    return _single_rule(d, codes.combined_usage)


@_query
def code_99457(d: Domain) -> DataFrame:
    return _single_rule(d, codes.first_talk)


def _before_extra_talk(d: Domain) -> tuple[activity.Activity, codes.CodeState]:
    act = billing.shared_activity(d, AS_OF)
    empty = codes.CodeState.empty(d.spark)
    return act, codes.apply_rules(act, empty, AS_OF, codes.STANDARD_RUN[:-1])


@_query
def code_99458(d: Domain) -> DataFrame:
    act, state = _before_extra_talk(d)
    return _code_rows(codes.extra_talk(act, state, AS_OF))


@_query
def preview_99458(d: Domain) -> DataFrame:
    act, state = _before_extra_talk(d)
    preview = codes.extra_talk_preview(act, state, AS_OF)
    return preview.select("patient_id", "rpm_20_mins_blocks", "code_count").orderBy("patient_id")


@_query
def billing_fold(d: Domain) -> DataFrame:
    return _code_rows(billing.run_codes(d, AS_OF).codes)


def _until(d: Domain, day: str) -> dict[str, DataFrame]:
    """The tables of the rules with the readings and notes before ``day`` only."""
    tables = {name: d[name] for name in ("device", "note_type")}
    for name in ("glucose_reading", "blood_pressure_reading"):
        tables[name] = d[name].where(F.col("received_datetime") < moment(day))
    return {**tables, "patient_note": d["patient_note"].where(F.col("note_datetime") < moment(day))}


@_query
def billing_fold_second_run(d: Domain) -> DataFrame:
    """The rows a later run adds to the stored codes of an earlier run over what there was then."""
    code_type = d["medical_code_type"]
    first = codes.code_tables(billing.run_codes(_until(d, FIRST_RUN), FIRST_RUN), code_type)
    earlier = codes.CodeState.stored(*(materialise(rows) for rows in first), code_type)
    second = billing.run_codes(d, AS_OF, earlier)
    return _code_rows(second.codes.where(F.col("rule").isNotNull()))


@_query
def code_device_links(d: Domain) -> DataFrame:
    return billing.run_codes(d, AS_OF).links.select("patient_id", "code", "device_id")


# --- reports ------------------------------------------------------------------------


def _report(d: Domain, start: str, end: str, ordered: bool) -> DataFrame:
    return reports.billing_report(
        d["patient"],
        d["patient_address"],
        d["patient_insurance"],
        d["medical_necessity"],
        billing.run_codes(d, AS_OF).codes,
        start,
        end,
        ordered,
    )


@_query
def billing_report(d: Domain) -> DataFrame:
    return _report(d, REPORT_START, REPORT_END, True)


@_query
def billing_report_open(d: Domain) -> DataFrame:
    return _report(d, OPEN_REPORT_START, AS_OF, False)


def _board_tables(d: Domain) -> list[DataFrame]:
    return [
        d["patient_status"],
        d["patient_address"],
        d["patient_note"],
        d["device"],
        d["glucose_reading"],
        d["blood_pressure_reading"],
    ]


@_query
def coach_queue(d: Domain) -> DataFrame:
    return reports.coach_queue(d["patient"], d["user"], *_board_tables(d), COACH, DASHBOARD_TIME)


@_query
def coach_queue_raw(d: Domain) -> DataFrame:
    return reports.coach_queue(
        d["patient"], d["user"], *_board_tables(d), COACH, DASHBOARD_TIME, distinct=False
    )


@_query
def patient_overview(d: Domain) -> DataFrame:
    return reports.patient_overview(d["patient"], *_board_tables(d), DASHBOARD_TIME)


@_query
def patient_overview_one(d: Domain) -> DataFrame:
    return reports.patient_overview(d["patient"], *_board_tables(d), DASHBOARD_TIME, patient_id=ONE_PATIENT)


@_query
def patient_search_phone(d: Domain) -> DataFrame:
    """An eleven-digit number whose first ten digits are another patient's number."""
    return reports.patient_search(d["patient"], *_board_tables(d), DASHBOARD_TIME, phone_number=LONG_PHONE)


@_query
def patient_search_id(d: Domain) -> DataFrame:
    return reports.patient_search(d["patient"], *_board_tables(d), DASHBOARD_TIME, patient_id=ONE_PATIENT)


@_query
def patient_search(d: Domain) -> DataFrame:
    return reports.patient_search(
        d["patient"], *_board_tables(d), DASHBOARD_TIME, first_name="Cleo", last_name="Smith"
    )


@_query
def patient_search_any_case(d: Domain) -> DataFrame:
    return reports.patient_search(
        d["patient"], *_board_tables(d), DASHBOARD_TIME, last_name="o'BRIEN", collation=ANY_CASE
    )


@_query
def patient_search_all(d: Domain) -> DataFrame:
    return reports.patient_search(d["patient"], *_board_tables(d), DASHBOARD_TIME)


def _study(d: Domain, pressure: str) -> DataFrame:
    return reports.study_extract(
        d["patient"],
        d["patient_address"],
        d["patient_insurance"],
        d["medical_necessity"],
        d["device"],
        d["glucose_reading"],
        d[pressure],
        f"{AS_OF} 12:00:00",
    )


@_query
def study_extract(d: Domain) -> DataFrame:
    return _study(d, "blood_pressure_reading")


@_query
def study_extract_shared_devices(d: Domain) -> DataFrame:
    """Both kinds of reading on one device, where each can vouch for the other."""
    return _study(d, "pressure_on_same_device")


@_query
def latest_reading(d: Domain) -> DataFrame:
    return activity.latest_reading(d["glucose_reading"], d["blood_pressure_reading"])


@_query
def month_minutes(d: Domain) -> DataFrame:
    return reports.month_minutes(d["patient"], d["patient_note"], DASHBOARD_TIME)


@_query
def owned_devices(d: Domain) -> DataFrame:
    return reports.owned_devices(d["device"])


@_query
def billing_cycle_filter(d: Domain) -> DataFrame:
    """Orders of the billing cycle before each customer's latest order."""
    orders = d.given("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"))
    first, last = last_billing_cycle(F.to_date("latest"))
    placed = orders.join(latest, "o_custkey")
    return placed.where(
        (F.col("o_orderdate") >= first) & (F.col("o_orderdate") <= last)
    ).select("o_orderkey", first.alias("cycle_start"), last.alias("cycle_end"))


# --- cleansing ------------------------------------------------------------------------


def _cleansed(d: Domain, **columns) -> DataFrame:
    export = d.raw("patient_export")
    return export.select(
        F.col("ID").cast("bigint").alias("sharepoint_id"),
        *(column.alias(name) for name, column in columns.items()),
    )


@_query
def clean_patients(d: Domain) -> DataFrame:
    return normalize.normalize_patients(d.raw("patient_export"))


@_query
def clean_names(d: Domain) -> DataFrame:
    first = cleanse.name(F.col("First Name"), cleanse.PERSON_NAME_DROPS)
    last = cleanse.name(F.col("Last Name"), cleanse.PERSON_NAME_DROPS)
    return _cleansed(
        d,
        first_name=first,
        last_name=last,
        full_name=cleanse.full_name(first, last),
        middle_name=cleanse.name(F.col("Middle Name"), cleanse.MIDDLE_NAME_DROPS),
        nick_name=cleanse.short_title(F.col("Nickname")),
        name_suffix=cleanse.short_title(F.col("Suffix")),
    )


@_query
def clean_states(d: Domain) -> DataFrame:
    return _cleansed(
        d,
        temp_state=cleanse.state(F.col("State")),
        city=cleanse.name(F.col("City"), cleanse.CITY_DROPS),
        street_address=cleanse.name(F.col("Mailing Address"), cleanse.STREET_DROPS),
        zipcode=cleanse.zip_base(F.col("Zip code")),
    )


@_query
def clean_insurers(d: Domain) -> DataFrame:
    return _cleansed(
        d,
        payer=cleanse.insurer(F.col("`Insurance Name:`")),
        second_payer=cleanse.insurer(F.col("InsuranceName2")),
    )


@_query
def clean_ids(d: Domain) -> DataFrame:
    return _cleansed(
        d,
        beneficiary_id=cleanse.beneficiary_id(F.col("Medicare ID number")),
        payer_id=cleanse.insurance_id(F.col("`Insurance ID:`")),
        second_payer_id=cleanse.insurance_id(F.col("InsuranceID2")),
        email=cleanse.email(F.col("Email")),
        phone_number=cleanse.digits_only(F.col("Phone Number")),
        social_security=cleanse.digits_only(F.col("Social Security")),
    )


@_query
def clean_dx(d: Domain) -> DataFrame:
    return _cleansed(d, dx_codes=cleanse.diagnosis_codes(F.col("DX_Code")))


@_query
def clean_body(d: Domain) -> DataFrame:
    return _cleansed(
        d,
        weight_lbs=cleanse.weight_lbs(F.col("Weight")),
        height_in=cleanse.height_in(F.col("Height")),
        race=cleanse.race(F.col("Race")),
        sex=cleanse.sex(F.col("Gender")),
        status=cleanse.member_status(F.col("Member_Status")),
    )


@_query
def clean_contacts(d: Domain) -> DataFrame:
    return _cleansed(
        d,
        contact=cleanse.name(F.col("EmergencyName"), cleanse.CONTACT_NAME_DROPS),
        relationship=cleanse.relationship(F.col("EmergencyName")),
        relationship2=cleanse.relationship(F.col("EmergencyName2")),
    )


@_query
def fill_payer(d: Domain) -> DataFrame:
    return clean_patients(d).select("sharepoint_id", "primary_payer_name", "primary_payer_id")


@_query
def parse_dates(d: Domain) -> DataFrame:
    """The two date columns of the export."""
    return _cleansed(
        d,
        date_of_birth=normalize.parsed_timestamp(F.col("DOB")),
        evaluation_datetime=normalize.parsed_timestamp(F.col("On-board Date")),
    )


@_query
def clean_users(d: Domain) -> DataFrame:
    return normalize.normalize_users(d.raw("directory"))


@_query
def clean_devices(d: Domain) -> DataFrame:
    return normalize.normalize_devices(readers.supplied_devices(d.raw("fulfillment")))


@_query
def clean_glucose(d: Domain) -> DataFrame:
    return normalize.normalize_bg_readings(d.raw("glucose_log"))


@_query
def clean_bp(d: Domain) -> DataFrame:
    return normalize.normalize_bp_readings(d.raw("pressure_log"))


@_query
def merge_notes(d: Domain) -> DataFrame:
    return normalize.merge_notes(d.raw("notes_log"), d.raw("time_log"))


@_query
def clean_notes(d: Domain) -> DataFrame:
    return normalize.normalize_patient_notes(merge_notes(d))


@_query
def note_texts(d: Domain) -> DataFrame:
    """HTML references and tags removed from whole web pages."""
    return d.given("pages").select("page_id", cleanse.plain_text(F.col("html")).alias("note_content"))


# --- source windows -------------------------------------------------------------------


@_query
def scan_glucose(d: Domain) -> DataFrame:
    return readers.glucose_window(d.raw("glucose_log"), SCAN_START, SCAN_END)


@_query
def scan_bp(d: Domain) -> DataFrame:
    return readers.pressure_window(d.raw("pressure_log"), SCAN_START, SCAN_END)


@_query
def scan_notes(d: Domain) -> DataFrame:
    return readers.notes_window(d.raw("notes_log"), SCAN_START, SCAN_END)


@_query
def scan_time_log(d: Domain) -> DataFrame:
    return readers.time_window(d.raw("time_log"), SCAN_START, SCAN_END)


@_query
def scan_fulfillment(d: Domain) -> DataFrame:
    return readers.supplied_devices(d.raw("fulfillment"))


# --- entities, checks, keys --------------------------------------------------------------


@_query
def split_patient(d: Domain) -> DataFrame:
    return entities.patients(clean_patients(d))


@_query
def split_address(d: Domain) -> DataFrame:
    return entities.addresses(clean_patients(d))


@_query
def split_insurance(d: Domain) -> DataFrame:
    return entities.insurances(clean_patients(d))


@_query
def split_dx(d: Domain) -> DataFrame:
    return entities.medical_necessities(clean_patients(d))


@_query
def split_status(d: Domain) -> DataFrame:
    return entities.statuses(clean_patients(d), LOADED_AT)


@_query
def split_contacts(d: Domain) -> DataFrame:
    return entities.emergency_contacts(clean_patients(d))


@_query
def constraint_pass(d: Domain) -> DataFrame:
    return quality.within_limits(clean_patients(d))


@_query
def rejects(d: Domain) -> DataFrame:
    return quality.rejects(clean_patients(d)).select(
        "error_type", "sharepoint_id", "first_name", "last_name"
    )


@_query
def resolve_keys(d: Domain) -> DataFrame:
    """Diagnosis rows of the export under the patient's id."""
    return keys.resolve_to_patient(split_dx(d), d["patient"])


@_query
def resolve_status(d: Domain) -> DataFrame:
    return keys.resolve_to_patient(split_status(d), d["patient"])


@_query
def resolve_contacts(d: Domain) -> DataFrame:
    return keys.resolve_to_patient(split_contacts(d), d["patient"])


@_query
def resolve_notes(d: Domain) -> DataFrame:
    return keys.resolve_notes(clean_notes(d), d["patient"])


@_query
def resolve_devices(d: Domain) -> DataFrame:
    return keys.resolve_devices(clean_devices(d), d["patient"], d["vendor"])


@_query
def resolve_readings(d: Domain) -> DataFrame:
    return keys.resolve_readings(clean_glucose(d), d["patient"], d["device"])


@_query
def lookup_note_type(d: Domain) -> DataFrame:
    return load.link_note_type(clean_notes(d), d["note_type"])


@_query
def lookup_status_type(d: Domain) -> DataFrame:
    return load.link_status_type(d["patient_status"], d["patient_status_type"])


@_query
def lookup_coach(d: Domain) -> DataFrame:
    patients = d["patient"].select("patient_id", "temp_user")
    return load.link_coach(patients, d["user"])


@_query
def lookup_note_author(d: Domain) -> DataFrame:
    return load.link_author(clean_notes(d), d["user"])


@_query
def surrogate_keys(d: Domain) -> DataFrame:
    """Ids for the accepted patients, after those already given out."""
    accepted = load.staged_patients(d.raw("patient_export"), LOADED_AT)["patient"]
    named = accepted.select("sharepoint_id", "full_name")
    return keys.assign_ids(named, "patient_id", ["sharepoint_id"], d["patient"])


@_query
def stored_code_ids(d: Domain) -> DataFrame:
    """The fold as ``medical_code`` rows with ids, joined with their device links."""
    code_type = d["medical_code_type"]
    rows, links = codes.code_tables(billing.run_codes(d, AS_OF), code_type)
    per_code = links.groupBy("med_code_id").agg(F.count("device_id").alias("linked_devices"))
    return rows.join(per_code, "med_code_id", "left").select(
        "patient_id",
        "med_code_type_id",
        "timestamp_applied",
        F.coalesce("linked_devices", F.lit(0)).alias("linked_devices"),
    )


@_query
def load_and_bill(d: Domain) -> DataFrame:
    """Raw sources to the billing report in one run: load, code, report."""
    sources = load.RawSources(
        directory=d.raw("directory"),
        patient_export=d.raw("patient_export"),
        fulfillment=d.raw("fulfillment"),
        glucose_log=d.raw("glucose_log"),
        pressure_log=d.raw("pressure_log"),
        notes_log=d.raw("notes_log"),
        time_log=d.raw("time_log"),
        vendor=d["vendor"],
        note_type=d["note_type"],
        patient_status_type=d["patient_status_type"],
    )
    tables = load.load_tables(sources, "2024-01-01", "2024-01-31", LOADED_AT)
    tables["note_type"] = d["note_type"]
    _, report = billing.run_billing(tables, "2024-01-01", "2024-01-31")
    return report


# --- files and stored tables -------------------------------------------------------------


def _landing(d: Domain) -> str:
    """A new folder beside the intermediate tables."""
    return f"{shared_folder(d.spark)}/landed-{uuid.uuid4().hex}"


@_query
def export_csv(d: Domain) -> DataFrame:
    """The whole export, written as CSV files and read back."""
    path = _landing(d)
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    d.raw("patient_export").write.options(**options).csv(path)
    return readers.read_patient_export(d.spark, path)


@_query
def directory_json(d: Domain) -> DataFrame:
    """Members in directory documents of one initial each, written and unwrapped."""
    path = _landing(d)
    members = d.raw("directory").groupBy(F.col("id").alias("page")).agg(
        F.collect_list(F.struct("givenName", "surname", "displayName", "mail", "id")).alias("value")
    )
    members.repartition("page").write.partitionBy("page").json(path)
    return readers.read_directory(d.spark, path)


@_query
def append_twice(d: Domain) -> DataFrame:
    """Readings stored by month, appended in two parts."""
    root, readings = _landing(d), d["glucose_reading"]
    early = F.col("received_datetime") < moment(FIRST_RUN)
    writers.write_table(readings.where(early), root, "glucose_reading", "fail")
    writers.write_table(readings.where(~early), root, "glucose_reading", "append")
    return readers.read_stored(d.spark, root, "glucose_reading")


@_query
def reset_then_append(d: Domain) -> DataFrame:
    """A reset and what is written after it, as one change of a stored table."""
    root = _landing(d)
    with versions.change(d.spark, root) as new:
        new.append(d["patient_note"], "patient_note")
    with versions.change(d.spark, root) as new:
        new.reset(TARGETS)
        new.append(_until(d, FIRST_RUN)["patient_note"], "patient_note")
    return readers.read_stored(d.spark, root, "patient_note", since=SCAN_START)


@_query
def replaced_codes(d: Domain) -> DataFrame:
    """A code table that is reset and filled anew by the ids of a run, as one change."""
    root, code_type = _landing(d), d["medical_code_type"]
    rows, _ = codes.code_tables(billing.run_codes(d, AS_OF), code_type)
    with versions.change(d.spark, root) as new:
        new.append(rows, "medical_code")
    with versions.change(d.spark, root) as new:
        new.reset(CODE_TABLES)
        new.append(rows.where("med_code_type_id = 1"), "medical_code")
    return readers.read_stored(d.spark, root, "medical_code").drop("med_code_id")


@_query
def report_csv(d: Domain) -> DataFrame:
    """The billing report as exported: CSV with a header, every cell as text."""
    path = _landing(d)
    writers.write_report(billing_report(d), path)
    return d.spark.read.option("header", True).csv(path).select("ID", "DateOfService", *CODE_COLUMNS)


@_query
def snapshots(d: Domain) -> DataFrame:
    """Staged patients, stored for inspection and read with their dates."""
    path = _landing(d)
    writers.write_snapshots({"patient": split_patient(d)}, path)
    return readers.read_table(d.spark, f"{path}/snap_patient", ["date_of_birth"])


# --- over stored summaries ---------------------------------------------------------------


def _in_two_loads(d: Domain) -> str:
    """The tables stored by two loads, the second adding its readings and notes to the summaries."""
    root, facts = _landing(d), (*month.READING_TABLES, "patient_note")
    with versions.change(d.spark, root) as new:
        for name in STORED_TABLES:
            new.append(d[name], name)
        for name in facts:
            new.append(_until(d, FIRST_RUN)[name], name)
        month.add_activity(new)
    with versions.change(d.spark, root) as new:
        for name in facts:
            early = F.coalesce(F.col(MONTH_OF[name]) < moment(FIRST_RUN), F.lit(False))
            new.append(d[name].where(~early), name)
        month.add_activity(new)
    return root


@_query
def billing_fold_stored(d: Domain) -> DataFrame:
    """The fold over stored summaries; no reading or note is read."""
    tables = month.summed_tables(d.spark, _in_two_loads(d), d["note_type"])
    return _code_rows(billing.run_codes(tables, AS_OF).codes)


@_query
def coach_queue_stored(d: Domain) -> DataFrame:
    return dashboards.coach_queue(d.spark, _in_two_loads(d), COACH, DASHBOARD_TIME)


@_query
def patient_search_stored(d: Domain) -> DataFrame:
    return dashboards.patient_search(d.spark, _in_two_loads(d), DASHBOARD_TIME)


@_query
def study_extract_stored(d: Domain) -> DataFrame:
    return dashboards.study_extract(d.spark, _in_two_loads(d), f"{AS_OF} 12:00:00")
