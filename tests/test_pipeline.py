"""Files in, tables and report out."""

import csv
import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulseledger import schemas
from pulseledger.operators import normalize, quality
from pulseledger.plans import billing, load, month
from pulseledger.sources import readers, writers

# One patient per row: complete, sparse, and one whose cells break the rules.
EXPORT = {
    "ID": ["1", "2", "3"],
    "Member_Status": ["Active", "On-Board", "In-Active"],
    "Health Coach": ["Alex Coach", "nobody", "Alex Coach"],
    "On-board Date": ["2023-01-01", "2/15/2023 2:30 PM", "2023"],
    "DOB": ["04/09/1951", "11/30/1948", "sometime"],
    "First Name": ["  bruno", "ODA", "Kit"],
    "Last Name": ["o'hara", "Van Dyk", "Lund"],
    "Middle Name": ["q", "", "Mo"],
    "Nickname": ["bru", "NaN", "K"],
    "Suffix": ["sr", "", "N/A"],
    "Gender": ["Male", "Female", "Other"],
    "Relationship_Status": ["Widowed", "Single", "Married"],
    "Preferred_Language": ["Spanish", "English", "English"],
    "Race": ["African American", "latin", "prefer not to say"],
    "Weight": ["212.5 lbs", "98", "heavy, in kg"],
    "Height": ["6'1\"", "5'0\"", "tall"],
    "Email": [" BRUNO@MAIL.EXAMPLE ", "oda@mail.example", "kit at mail"],
    "Phone Number": ["(808) 555-0101", "+1 808 555 0102", "8085550103"],
    "Social Security": ["900 11 2222", "900-33-4444", "900-55-6666"],
    "Mailing Address": ["7 Pier Lane\nUnit B", "31 Hill St.", "12 Quay"],
    "City": ["Hilo", "El Paso", "Nowhere"],
    "State": ["hawaii", "TEXAS", "atlantis"],
    "Zip code": ["09672", "79901-4455", "12345"],
    "EmergencyName": ["Lena (daughter)", "Sam", ""],
    "EmergencyNumber": ["808-555-0111", "915-555-0112", ""],
    "EmergencyName2": ["", "", "Noor"],
    "EmergencyNumber2": ["", "", "808-555-0113"],
    "Medicare ID number": ["2AA3-BB4-CC55", "7DD8-EE9-FF10", "4GG5-HH6-JJ77"],
    "Insurance Name:": ["", "", "keiser gold"],
    "Insurance ID:": ["xy-987-zw", "", "qr-654-st"],
    "InsuranceName2": ["Tricare", "", ""],
    "InsuranceID2": ["", "", "uv-321-wx"],
    "DX_Code": ["E11.9 / I50.9", "R05", "I10,E78.5"],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("landed")


@pytest.fixture(scope="module")
def export(spark, folder):
    path = folder / "Patient_Export.csv"
    with path.open("w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(EXPORT)
        writer.writerows(zip(*EXPORT.values()))
    return readers.read_patient_export(spark, str(path), multi_line=True)


@pytest.fixture(scope="module")
def sources(spark, folder, export):
    members = [
        {"givenName": "Alex", "surname": "Coach", "displayName": "Alex Coach", "mail": "a@x.org", "id": "e1"},
        {"givenName": None, "surname": "B", "displayName": "B", "mail": None, "id": "e2"},
    ]
    (folder / "members.json").write_text(json.dumps({"value": members}, indent=1))
    start = dt.datetime(2024, 1, 10, 8)
    readings = [
        (1, "GM", start + dt.timedelta(days=n), start + dt.timedelta(days=n), "101.505", n % 2 == 0)
        for n in range(16)
    ]
    outside = [(1, "GM", dt.datetime(2024, 1, 31, 0, 1), dt.datetime(2024, 1, 31, 0, 1), "1", True)]
    notes = [
        (1, "<b>hi</b> &amp; bye", dt.datetime(2024, 1, 15), "Alex Coach", None, 5),
        (2, "NA", dt.datetime(2024, 1, 16), "NursePractitioner", "x", 6),
    ]
    times = [
        (1, "0:30:00", "Alex Coach", "Follow-up, more", True, start, dt.datetime(2024, 1, 15), 5),
        (1, "0:50:00", "Alex Coach", "Follow-up", False, start, dt.datetime(2024, 1, 15), 5),
    ]
    devices = [
        ("Tenovi", "a-1", "Tenovi Glucometer", 1, False),
        ("Omron", "b-2", "Omron BPM", 2, False),
        ("Omron", "c-3", "Omron BPM", 2, True),
        ("Other", "d-4", "Other", 1, False),
    ]
    frame = lambda rows, name: spark.createDataFrame(rows, schemas.SOURCES[name])
    return load.RawSources(
        directory=readers.read_directory(spark, str(folder / "members.json")),
        patient_export=export,
        fulfillment=frame(devices, "fulfillment"),
        glucose_log=frame(readings + outside, "glucose_log"),
        pressure_log=frame([], "pressure_log"),
        notes_log=frame(notes, "notes_log"),
        time_log=frame(times, "time_log"),
        vendor=schemas.lookup_frame(spark, "vendor_id", schemas.VENDORS),
        note_type=schemas.lookup_frame(spark, "note_type_id", schemas.NOTE_TYPES),
        patient_status_type=schemas.lookup_frame(spark, "patient_status_type_id", schemas.STATUS_TYPES),
    )


@pytest.fixture(scope="module")
def tables(sources):
    loaded = load.load_tables(sources, "2024-01-01", "2024-01-31", "2024-02-01 08:00:00")
    return {name: frame.cache() for name, frame in loaded.items()}


def test_export_cells(export):
    rows = {row.ID: row for row in export.collect()}
    assert set(export.columns) == set(EXPORT)
    assert rows["2"]["Middle Name"] is None and rows["2"]["Nickname"] is None
    assert rows["3"]["Suffix"] is None and rows["1"]["Zip code"] == "09672"
    assert rows["1"]["Mailing Address"] == "7 Pier Lane\nUnit B" and rows["1"]["Height"] == "6'1\""
    assert rows["1"]["DOB"] == dt.datetime(1951, 4, 9) and rows["3"]["DOB"] is None
    assert rows["2"]["On-board Date"] == dt.datetime(2023, 2, 15, 14, 30) and rows["3"]["On-board Date"] is None


def test_an_export_without_a_column_is_an_error(spark, tmp_path):
    (tmp_path / "short.csv").write_text("ID,City\n1,Hilo\n")
    with pytest.raises(ValueError, match="First Name"):
        readers.read_patient_export(spark, str(tmp_path / "short.csv"))


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("1/5/2023 14:30", dt.datetime(2023, 1, 5, 14, 30)),
        ("1/5/2023 12:05:09 am", dt.datetime(2023, 1, 5, 0, 5, 9)),
        ("01/05/2023", dt.datetime(2023, 1, 5)),
        ("2023-01-05 07:08:09", dt.datetime(2023, 1, 5, 7, 8, 9)),
        ("1/5/2023 25:00", None),
        ("2/30/2023", None),
        ("2023", None),
        ("soon", None),
        (None, None),
    ],
)
def test_date_cells(spark, cell, expected):
    frame = spark.createDataFrame([(cell,)], "cell string")
    assert frame.select(normalize.parsed_timestamp(F.col("cell")).alias("day")).first().day == expected


def test_normalised_and_constrained(export):
    cleansed = normalize.normalize_patients(export)
    rows = {row.sharepoint_id: row for row in cleansed.collect()}
    assert len(cleansed.columns) == 36
    assert rows[3].weight_lbs is None and rows[3].height_in is None and rows[3].email is None
    assert rows[2].middle_name is None and rows[2].nick_name is None
    assert rows[1].street_address == "7 Pier Lane Unit B"
    kept = {row.sharepoint_id for row in quality.within_limits(cleansed).collect()}
    assert kept == {1, 2}
    errors = {(row.sharepoint_id, row.error_type) for row in quality.rejects(cleansed).collect()}
    assert (3, "phone number length error") in errors
    assert not any(error == "duplicate patient" for _, error in errors)


def test_loaded_tables(tables):
    assert set(tables) == set(schemas.TARGETS) - set(schemas.CODE_TABLES)
    for name, frame in tables.items():
        assert frame.columns == schemas.target_schema(name).names
    patients = {row.sharepoint_id: row for row in tables["patient"].collect()}
    assert set(patients) == {1, 2}
    bruno, oda = patients[1].patient_id, patients[2].patient_id
    assert sorted([bruno, oda]) == [1, 2]
    assert patients[1].user_id is not None and patients[2].user_id is None
    by_patient = lambda name: {row.patient_id: row for row in tables[name].collect()}
    assert by_patient("patient_address")[bruno].temp_state == "HI"
    assert by_patient("patient_insurance")[oda].primary_payer_name == "Medicare Part B"
    assert by_patient("patient_insurance")[oda].primary_payer_id == "7DD8EE9FF10"
    assert by_patient("patient_insurance")[bruno].primary_payer_name is None
    status = by_patient("patient_status")
    assert status[oda].temp_status_type == "Onboard" and status[oda].patient_status_type_id == 4
    codes = sorted((row.patient_id, row.temp_dx_code) for row in tables["medical_necessity"].collect())
    assert codes == sorted([(bruno, "E119"), (bruno, "I509"), (oda, "R05")])
    assert tables["emergency_contact"].count() == 2
    for name in ("patient_address", "patient_status", "emergency_contact", "medical_necessity"):
        assert {row.patient_id for row in tables[name].collect()} <= {bruno, oda}
    assert sorted(row.hardware_uuid for row in tables["device"].collect()) == ["a1", "b2"]
    readings = tables["glucose_reading"].collect()
    assert len(readings) == 16 and {row.glucose_reading for row in readings} == {101.5}
    notes = sorted(tables["patient_note"].collect(), key=lambda row: (row.patient_id, row.call_time_seconds))
    assert [(n.patient_id, n.call_time_seconds, n.temp_note_type, n.note_content, n.is_manual) for n in notes] == [
        (bruno, 1800, "Follow-up", "hi & bye", 0),
        (bruno, 3000, "Follow-up", "hi & bye", 1),
        (oda, 900, "Initial Evaluation", None, None),
    ]
    assert [n.note_type_id for n in notes] == [2, 2, 1]


def test_billing_of_the_loaded_tables(spark, sources, tables):
    state, report = billing.run_billing({**tables, "note_type": sources.note_type}, "2024-01-01", "2024-01-31")
    codes = sorted((row.patient_id, row.code) for row in state.codes.collect())
    bruno = tables["patient"].where("sharepoint_id = 1").first().patient_id
    oda = 3 - bruno
    assert codes == sorted(
        [(bruno, "99453"), (bruno, "99454"), (bruno, "99457")] + [(bruno, "99458")] * 3 + [(oda, "99202")]
    )
    rows = [(row.DateOfService, row.ID, row.DXCodes) for row in report.collect()]
    assert sorted(rows) == [
        (dt.date(2024, 1, 15), 1, "E119, I509"),
        (dt.date(2024, 1, 16), 2, "R05"),
        (dt.date(2024, 1, 25), 1, "E119, I509"),
    ]


def test_tables_are_written_appended_and_reset(spark, tables, tmp_path):
    root = str(tmp_path)
    writers.write_table(tables["patient"], root, "patient", "fail")
    with pytest.raises(Exception, match="exist"):
        writers.write_table(tables["patient"], root, "patient", "fail")
    writers.write_table(tables["patient"], root, "patient")
    assert spark.read.parquet(f"{root}/patient").count() == 4
    writers.write_table(tables["glucose_reading"], root, "glucose_reading", "replace")
    stored = spark.read.parquet(f"{root}/glucose_reading")
    assert stored.where("month = '2024-01'").count() == 16
    assert stored.select("received_datetime").dtypes == [("received_datetime", "timestamp_ntz")]
    recent = readers.read_stored(spark, root, "glucose_reading", since="2024-01-20")
    assert recent.columns == schemas.target_schema("glucose_reading").names and recent.count() == 6
    assert readers.read_stored(spark, root, "glucose_reading").count() == 16
    assert readers.read_stored(spark, root, "glucose_reading", since="2024-02-01").count() == 0
    writers.reset_billing_tables(spark, root)
    for name in schemas.TARGETS:
        empty = spark.read.schema(schemas.target_schema(name)).parquet(f"{root}/{name}")
        assert empty.count() == 0
    writers.write_table(spark.createDataFrame([(1, 2)], "med_code_id bigint, device_id bigint"), root, "medical_code_device")
    writers.reset_code_tables(spark, root)
    assert spark.read.parquet(f"{root}/medical_code_device").count() == 0


def test_report_and_snapshots(spark, tables, tmp_path):
    report = spark.createDataFrame([(1, "a"), (2, None)], "`99202` int, Name string").orderBy("99202")
    writers.write_report(report, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).columns == ["99202", "Name"]
    writers.write_report(report, str(tmp_path / "parquet"), "parquet")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    writers.write_snapshots({"patient": tables["patient"]}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "snap_patient")).count() == 2
    written = readers.read_table(spark, str(tmp_path / "snap_patient"), ["date_of_birth"])
    assert dict(written.dtypes)["date_of_birth"] == "timestamp_ntz"


def test_notes_without_log_keep_a_null_call_time(spark):
    notes = spark.createDataFrame(
        [(1, "n", dt.datetime(2024, 1, 1), "A", "t", None), (1, "m", dt.datetime(2024, 1, 1), "B", None, 3)],
        schemas.SOURCES["notes_log"],
    )
    times = spark.createDataFrame(
        [(1, None, "A", "l", True, None, None, None), (1, "0:01:00", "A", "l", False, None, None, None)],
        schemas.SOURCES["time_log"],
    )
    merged = normalize.merge_notes(notes, times)
    found = sorted((r.Notes, r.Time_Note, r.Recording_Time) for r in merged.collect() if r.Notes == "n")
    assert found == [("n", "t", 0.0), ("n", "t", 60.0)]
    assert merged.where(F.col("Notes") == "m").first().Recording_Time is None


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from pulseledger import session

    class Remote:
        class conf:
            @staticmethod
            def get(key, default=None):
                return None

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Remote)


def test_a_month_on_disk(spark, sources, tmp_path):
    root, snaps, report = (str(tmp_path / name) for name in ("tables", "snaps", "report"))
    month.load_month(spark, sources, root, "2024-01-01", "2024-01-31", "2024-02-01 08:00:00", snaps)
    code_type = schemas.lookup_frame(spark, "med_code_type_id", schemas.MEDICAL_CODES)
    for _ in range(2):  # a second run starts from emptied code tables
        month.bill_month(spark, root, sources.note_type, code_type, "2024-01-01", "2024-01-31", report)
    codes = readers.read_stored(spark, root, "medical_code")
    assert codes.count() == 7 and {row.med_code_id for row in codes.collect()} == set(range(1, 8))
    links = readers.read_stored(spark, root, "medical_code_device").collect()
    assert len(links) == 1
    linked = codes.where(F.col("med_code_id") == links[0].med_code_id).first()
    assert linked.med_code_type_id == 2
    lines = spark.read.option("header", True).csv(report)
    assert lines.count() == 3 and lines.columns[-5:] == list(schemas.MEDICAL_CODES)
    assert spark.read.parquet(f"{snaps}/snap_glucose").columns[-2:] == ["BG_Reading", "Manual_Reading"]
    assert spark.read.parquet(f"{snaps}/snap_patient").count() == 2


def test_resets_empty_every_month_under_dynamic_overwrite(spark, tables, tmp_path):
    root = str(tmp_path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for mode in ("append", "replace"):
            writers.write_table(tables["glucose_reading"], root, "glucose_reading", mode)
        assert readers.read_stored(spark, root, "glucose_reading").count() == 16
        writers.reset_billing_tables(spark, root)
        assert readers.read_stored(spark, root, "glucose_reading").count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_a_failing_load_leaves_the_tables(spark, sources, tmp_path):
    root = str(tmp_path)
    month.load_month(spark, sources, root, "2024-01-01", "2024-01-31", "2024-02-01 08:00:00")
    twice = sources.note_type.unionByName(sources.note_type)
    with pytest.raises(Exception, match="more than one lookup row"):
        month.load_month(
            spark, replace(sources, note_type=twice), root, "2024-01-01", "2024-01-31", "2024-02-01 08:00:00"
        )
    assert readers.read_stored(spark, root, "glucose_reading").count() == 16
    assert readers.read_stored(spark, root, "patient").count() == 2


def test_scratch_tables_go(spark, tmp_path):
    from pathlib import Path

    from pulseledger.session import materialise, scratch, shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with scratch(spark):
        assert materialise(spark.range(3)).count() == 3
        assert set(folder.iterdir()) > before
    assert set(folder.iterdir()) == before
