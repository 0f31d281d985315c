"""Billing rules: thresholds, windows, order, and the known counts of the given tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseledger import schemas
from pulseledger.catalogue.domain import AS_OF, Domain
from pulseledger.operators import codes
from pulseledger.plans import billing

DAY0 = dt.datetime(2024, 1, 1, 9)
READING = "device_id bigint, received_datetime timestamp_ntz"
NOTE = "patient_id bigint, note_datetime timestamp_ntz, call_time_seconds bigint, note_type_id bigint"


def tables(spark, device=(), glucose=(), pressure=(), notes=()):
    return {
        "device": spark.createDataFrame(list(device), "device_id bigint, patient_id bigint"),
        "glucose_reading": spark.createDataFrame(list(glucose), READING),
        "blood_pressure_reading": spark.createDataFrame(list(pressure), READING),
        "patient_note": spark.createDataFrame(list(notes), NOTE),
        "note_type": schemas.lookup_frame(spark, "note_type_id", schemas.NOTE_TYPES),
    }


def days(device_id, count, start=DAY0):
    return [(device_id, start + dt.timedelta(days=n)) for n in range(count)]


def given(df):
    return sorted(tuple(row) for row in df.select("patient_id", "code", "timestamp_applied").collect())


def run(spark, frames, as_of=AS_OF, state=None):
    return billing.run_codes(frames, as_of, state)


def test_first_visit_takes_15_to_under_30_minutes(spark):
    seconds = {1: 899, 2: 900, 3: 1799, 4: 1800}
    notes = [(patient, DAY0, value, 1) for patient, value in seconds.items()]
    notes += [(5, DAY0, 900, 2), (6, DAY0, 450, 1), (6, DAY0 + dt.timedelta(days=1), 450, 1)]
    state = run(spark, tables(spark, notes=notes), as_of="2024-06-01")
    assert given(state.codes) == [
        (2, "99202", DAY0),
        (3, "99202", DAY0),
        (6, "99202", DAY0 + dt.timedelta(days=1)),
    ]


def test_setup_needs_16_distinct_days_over_the_patients_devices(spark):
    device = [(10, 1), (11, 1), (20, 2), (30, 3)]
    glucose = days(10, 10) + days(11, 10, DAY0 + dt.timedelta(days=6)) + days(20, 15) * 3 + days(30, 16)
    glucose += days(99, 20)
    state = run(spark, tables(spark, device, glucose), as_of="2025-01-01")
    assert given(state.codes) == [
        (1, "99453", DAY0 + dt.timedelta(days=15)),
        (3, "99453", DAY0 + dt.timedelta(days=15)),
    ]
    links = sorted(tuple(row) for row in state.links.select("patient_id", "device_id").collect())
    assert links == [(1, 10), (1, 11), (3, 30)]


def test_pressure_setup_skips_devices_linked_by_glucose_setup(spark):
    device = [(10, 1), (11, 1), (21, 2)]
    frames = tables(spark, device, glucose=days(10, 16), pressure=days(11, 20) + days(21, 16))
    state = run(spark, frames, as_of="2025-01-01")
    assert [(p, c) for p, c, _ in given(state.codes)] == [(1, "99453"), (2, "99453")]


def test_usage_window_starts_30_days_before_and_has_no_end(spark):
    start = dt.datetime(2024, 1, 10)  # 30 days before 2024-02-09, at midnight
    device = [(10, 1), (20, 2), (30, 3)]
    glucose = days(10, 16, start) + days(20, 16, start - dt.timedelta(days=1)) + days(30, 16, dt.datetime(2024, 2, 20))
    frames = tables(spark, device, glucose)
    added = codes.glucose_usage(billing.scanned_activity(frames, AS_OF), codes.CodeState.empty(spark), AS_OF)
    assert given(added) == [
        (1, "99454", start + dt.timedelta(days=15)),
        (3, "99454", dt.datetime(2024, 3, 6)),
    ]


def test_usage_is_given_once_per_window(spark):
    device = [(10, 1), (11, 1)]
    start = dt.datetime(2024, 1, 12, 8)
    frames = tables(spark, device, days(10, 16, start), days(11, 18, start))
    state = run(spark, frames)
    assert [c for _, c, _ in given(state.codes)].count("99454") == 1
    again = run(spark, frames, state=state.as_earlier())
    assert given(again.codes.where("rule IS NOT NULL")) == []
    later = run(spark, frames, as_of="2024-02-27", state=state.as_earlier())
    assert given(later.codes.where("rule IS NOT NULL")) == []


def test_combined_usage_stamp_falls_to_pressure_when_not_comparable(spark):
    start = dt.datetime(2024, 1, 12)
    device = [(10, 1), (20, 2), (21, 2), (30, 3)]
    glucose = days(10, 16, start) + days(20, 20, start) + days(30, 3, start)
    pressure = days(21, 2, start) + days(30, 16, start)
    frames = tables(spark, device, glucose, pressure)
    added = codes.combined_usage(billing.scanned_activity(frames, AS_OF), codes.CodeState.empty(spark), AS_OF)
    rows = {row.patient_id: row.timestamp_applied for row in added.collect()}
    assert rows == {1: None, 2: start + dt.timedelta(days=19), 3: start + dt.timedelta(days=15)}


@pytest.mark.parametrize(
    ("seconds", "extra"), [(1199, 0), (1200, 0), (2399, 0), (2400, 1), (3600, 2), (4800, 3), (99999, 3)]
)
def test_talk_time_blocks(spark, seconds, extra):
    note = dt.datetime(2024, 1, 20)
    later = dt.datetime(2024, 3, 1)
    notes = [(1, note, seconds, 2), (1, later, 0, 2)]
    found = [(c, t) for _, c, t in given(run(spark, tables(spark, notes=notes)).codes)]
    first = [("99457", later)] if seconds >= 1200 else []
    assert found == sorted(first + [("99458", later)] * extra)


def test_extra_talk_counts_any_code_and_earlier_99458(spark):
    note = dt.datetime(2024, 1, 20)
    frames = tables(spark, notes=[(1, note, 4800, 2), (2, note, 4800, 2)])
    earlier = spark.createDataFrame(
        [(1, "99458", note, None), (1, "99457", note, None), (2, "99457", dt.datetime(2023, 6, 1), None)],
        codes.CODE_COLUMNS,
    )
    state = codes.CodeState(earlier, schemas.empty_frame(spark, codes.LINK_COLUMNS))
    added = run(spark, frames, state=state).codes.where("rule IS NOT NULL")
    counts = {(r.patient_id, r.code): r["count"] for r in added.groupBy("patient_id", "code").count().collect()}
    assert counts == {(1, "99458"): 2, (2, "99457"): 1, (2, "99458"): 3}


def test_month_window_clamps_at_the_end_of_february(spark):
    notes = [(1, dt.datetime(2025, 2, 28), 1200, 2), (2, dt.datetime(2025, 2, 27, 23), 1200, 2)]
    state = run(spark, tables(spark, notes=notes), as_of="2025-03-31")
    assert [(p, c) for p, c, _ in given(state.codes)] == [(1, "99457")]


# Known counts of the fold: first visit, set-up and usage by glucose and by
# pressure, first talk, extra talk.
KNOWN = {
    "first_visit": 4,
    "glucose_setup": 10,
    "pressure_setup": 5,
    "glucose_usage": 3,
    "pressure_usage": 4,
    "first_talk": 15,
    "extra_talk": 33,
}


def test_known_counts_of_the_smallest_tables(spark):
    domain = Domain(spark, "/root/testdata/sf0.001")
    state = billing.run_codes(domain, AS_OF)
    counted = {row.rule: row["count"] for row in state.codes.groupBy("rule").count().collect()}
    assert counted == KNOWN
    assert state.links.count() == 20
    days_of_service = state.codes.select("patient_id", F.to_date("timestamp_applied")).distinct()
    assert days_of_service.count() == 26
    per_device = state.links.where("code = '99453'").groupBy("device_id").count()
    assert per_device.where("count > 1").count() == 0


def test_stored_state_round_trip(spark):
    domain = Domain(spark, "/root/testdata/sf0.001")
    code_type = domain["medical_code_type"]
    state = billing.run_codes(domain, AS_OF)
    rows, links = codes.code_tables(state, code_type)
    assert rows.count() == sum(KNOWN.values()) and links.count() == 20
    assert rows.select("med_code_id").distinct().count() == rows.count()
    stored = codes.CodeState.stored(rows, links, code_type)
    assert given(stored.codes) == given(state.codes)
    again = billing.run_codes(domain, AS_OF, stored)
    assert again.codes.where("rule IS NOT NULL").count() == 0
