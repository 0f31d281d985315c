"""Reports against plain SQL on small random tables with every awkward case:
devices with both kinds of reading, patients without devices, repeated
addresses, null days and codes."""

import datetime as dt
import random

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from pulseledger.catalogue import oracle
from pulseledger.functions import dates
from pulseledger.operators import reports

NOW = "2024-01-25 10:30:00"
SCHEMAS = {
    "patient": "patient_id bigint, user_id bigint, first_name string, last_name string, full_name string, "
    "date_of_birth timestamp_ntz, sex string, phone_number string",
    "coach": "user_id bigint, display_name string",
    "patient_status": "patient_id bigint, temp_status_type string",
    "patient_address": "patient_id bigint, temp_state string",
    "patient_insurance": "patient_id bigint, medicare_beneficiary_id string",
    "medical_necessity": "patient_id bigint, temp_dx_code string",
    "patient_note": "patient_id bigint, note_datetime timestamp_ntz, call_time_seconds bigint",
    "device": "device_id bigint, patient_id bigint",
    "glucose_reading": "device_id bigint, received_datetime timestamp_ntz",
    "blood_pressure_reading": "device_id bigint, received_datetime timestamp_ntz",
}


def random_tables(seed):
    rng = random.Random(seed)

    def when():
        if rng.random() < 0.03:
            return None
        return dt.datetime(2023, 12, 10) + dt.timedelta(minutes=rng.randrange(50 * 24 * 60))

    patients = range(1, 9)
    devices = [(n, rng.choice(patients)) for n in range(1, 9)]
    readings = lambda: [(rng.randrange(1, 10), when()) for _ in range(260)]
    return {
        "patient": [
            (p, rng.randrange(3), rng.choice("AB"), rng.choice("XY"), f"P {p}",
             dt.datetime(1950, rng.randrange(1, 13), rng.randrange(1, 29)), "F", f"555{p:07d}")
            for p in patients
        ],
        "coach": [(0, "Kim"), (1, "Lou"), (2, "Max")],
        "patient_status": [(p, rng.choice(["Active", None])) for p in patients for _ in range(rng.randrange(1, 3))],
        "patient_address": [(p, rng.choice(["CA", "TX"])) for p in patients for _ in range(rng.randrange(1, 3))],
        "patient_insurance": [(p, f"M{p}") for p in patients],
        "medical_necessity": [
            (rng.choice(patients), rng.choice(["E119", "E119", "I10", "", None])) for _ in range(30)
        ],
        "patient_note": [(rng.choice(patients), when(), rng.choice([None, 30, 119, 900])) for _ in range(40)],
        "device": devices,
        "glucose_reading": readings(),
        "blood_pressure_reading": readings(),
    }


@pytest.fixture(params=range(4))
def world(request, spark):
    data = random_tables(request.param)
    frames = {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in data.items()}
    connection = duckdb.connect()
    for name, rows in data.items():
        columns = SCHEMAS[name].replace("string", "VARCHAR").replace("timestamp_ntz", "TIMESTAMP")
        connection.execute(f"CREATE TABLE {name} ({columns})")
        marks = ", ".join("?" for _ in rows[0])
        connection.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    connection.execute(f"CREATE VIEW reading AS {oracle.reading()[1]}")
    return frames, connection


def board(frames):
    return [frames[name] for name in ("patient_status", "patient_address", "patient_note", "device",
                                      "glucose_reading", "blood_pressure_reading")]


def test_boards(world):
    frames, connection = world
    of_kim = "c.user_id IN (SELECT user_id FROM coach WHERE display_name = 'Kim')"
    for distinct in (True, False):
        queue = reports.coach_queue(frames["patient"], frames["coach"], *board(frames), "Kim", NOW, distinct)
        assert differences(queue, connection, oracle.board_sql(of_kim, distinct, NOW)) == []
    everyone = reports.patient_search(frames["patient"], *board(frames), NOW)
    assert differences(everyone, connection, oracle.board_sql("TRUE", True, NOW)) == []
    assert differences(reports.coach_queue(frames["patient"], frames["coach"], *board(frames), "Kim", NOW),
                       connection, oracle.board_sql(of_kim, True, NOW)) == []
    found = reports.patient_search(frames["patient"], *board(frames), NOW, first_name="A", phone_number="5550000003")
    wanted = "c.first_name = 'A' AND c.phone_number = '5550000003'"
    assert differences(found, connection, oracle.board_sql(wanted, True, NOW)) == []


def test_overview_leaves_out_patients_without_device(world):
    frames, connection = world
    overview = reports.patient_overview(frames["patient"], *board(frames), NOW)
    owners = {row[0] for row in connection.execute("SELECT patient_id FROM device").fetchall()}
    rows = overview.collect()
    assert {row.patient_id for row in rows} == owners
    everyone = oracle.board_sql("TRUE", True, NOW)
    expected = connection.execute(
        f"SELECT DISTINCT patient_id, temp_status_type, temp_state, mon_min, mon_count FROM ({everyone})"
    ).fetchall()
    found = {(r.patient_id, r.temp_status_type, r.temp_state, r.mon_min, r.mon_count) for r in rows}
    assert found == {row for row in expected if row[0] in owners}
    one = sorted(owners)[0]
    single = reports.patient_overview(frames["patient"], *board(frames), NOW, patient_id=one)
    assert sorted(map(repr, single.collect())) == sorted(repr(r) for r in rows if r.patient_id == one)


def test_study_days_either_kind_vouches_for_the_other(world):
    frames, connection = world
    extract = reports.study_extract(
        frames["patient"], frames["patient_address"], frames["patient_insurance"],
        frames["medical_necessity"], frames["device"], frames["glucose_reading"],
        frames["blood_pressure_reading"], NOW,
    )
    assert differences(extract, connection, oracle.study_sql(NOW)) == []


def test_joined_codes_keep_repeats_and_skip_nulls(world):
    frames, connection = world
    sql = """SELECT patient_id, string_agg(temp_dx_code, ', ' ORDER BY temp_dx_code) AS dx_codes
        FROM medical_necessity GROUP BY patient_id"""
    assert differences(reports.joined_codes(frames["medical_necessity"], ", "), connection, sql) == []


def test_billing_report_repeats_lines_and_cuts_the_end_at_midnight(spark):
    day = dt.datetime(2024, 2, 1)
    codes = spark.createDataFrame(
        [(1, "99453", day), (1, "99454", day + dt.timedelta(hours=5)), (1, "99457", day + dt.timedelta(days=1)),
         (1, "99458", day + dt.timedelta(days=1, seconds=1)), (2, "99202", day), (1, "12345", day)],
        "patient_id bigint, code string, timestamp_applied timestamp_ntz",
    )
    text = "sharepoint_id bigint, first_name string, middle_name string, last_name string, name_suffix string, " \
        "date_of_birth timestamp_ntz, phone_number string, sex string"
    patient = spark.createDataFrame(
        [(p, 100 + p, "A", None, "B", None, day, "5", "F") for p in (1, 2)], "patient_id bigint, " + text
    )
    address = spark.createDataFrame(
        [(1, "s", "c", "CA", "1"), (1, "t", "c", "CA", "2"), (2, "u", "c", "TX", "3")],
        "patient_id bigint, street_address string, city string, temp_state string, zipcode string",
    )
    insurance = spark.createDataFrame(
        [(p, "m", "n", "i", None, None) for p in (1, 2)],
        "patient_id bigint, medicare_beneficiary_id string, primary_payer_name string, primary_payer_id string, "
        "secondary_payer_name string, secondary_payer_id string",
    )
    necessity = spark.createDataFrame(
        [(1, "I10"), (1, "E119"), (1, None), (1, "I10")], "patient_id bigint, temp_dx_code string"
    )
    report = reports.billing_report(
        patient, address, insurance, necessity, codes, "2024-02-01", "2024-02-02"
    )
    assert report.columns[0] == "DateOfService" and report.columns[-5:] == list(reports.MEDICAL_CODES)
    rows = sorted(
        (r.DateOfService.isoformat(), r.ID, r.Address, r.DXCodes, *r[-5:]) for r in report.collect()
    )
    assert rows == [
        ("2024-02-01", 101, "s", "E119, I10, I10", 0, 1, 1, 0, 0),
        ("2024-02-01", 101, "t", "E119, I10, I10", 0, 1, 1, 0, 0),
        ("2024-02-02", 101, "s", "E119, I10, I10", 0, 0, 0, 1, 0),
        ("2024-02-02", 101, "t", "E119, I10, I10", 0, 0, 0, 1, 0),
    ]


def test_billing_cycle(spark):
    days = [(dt.date(2024, 3, 15),), (dt.date(2024, 1, 15),), (dt.date(2024, 3, 31),)]
    frame = spark.createDataFrame(days, "d date")
    first, last = dates.last_billing_cycle(F.col("d"))
    assert [tuple(row) for row in frame.select(first, last).collect()] == [
        (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        (dt.date(2023, 12, 1), dt.date(2023, 12, 31)),
        (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
    ]


def test_age_counts_the_birthday_itself(spark):
    frame = spark.createDataFrame(
        [(dt.date(1960, 1, 25),), (dt.date(1960, 1, 26),), (dt.date(1960, 2, 1),), (dt.date(2000, 1, 1),)], "d date"
    )
    ages = [row[0] for row in frame.select(dates.age_years(F.col("d"), NOW)).collect()]
    assert ages == [64, 63, 63, 24]
