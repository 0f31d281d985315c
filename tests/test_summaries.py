"""Stored summaries and changes that take effect together."""

import datetime as dt
import io
from contextlib import redirect_stdout
from dataclasses import replace

import pytest
from compare import rows as plain_rows
from pyspark.sql import functions as F
from test_pipeline import export, folder, sources  # noqa: F401
from test_reports import NOW, board, world  # noqa: F401

from pulseledger import schemas
from pulseledger.operators import activity, reports, summaries
from pulseledger.plans import dashboards, month
from pulseledger.sources import readers, versions

JANUARY = ("2024-01-01", "2024-01-31")


def same(one, two):
    return plain_rows(one.columns, map(tuple, one.collect())) == plain_rows(two.columns, map(tuple, two.collect()))


def summed(frames):
    """Summaries of two loads, cut at a time of day."""
    parts = []
    for early in (True, False):
        cut = F.coalesce(F.col("received_datetime") < "2024-01-10 09:00:00", F.lit(False)) == early
        parts.append(summaries.reading_days(frames["glucose_reading"].where(cut), frames["blood_pressure_reading"].where(cut)))
    last = summaries.merged_last_readings(
        summaries.merged_last_readings(frames["device"].sparkSession.createDataFrame([], schemas.SUMMARIES["device_last_reading"]), parts[0]),
        parts[1],
    )
    return reports.SummedReadings(parts[0].unionByName(parts[1]), last)


def test_boards_over_summaries(world):  # noqa: F811
    frames, _ = world
    readings, others = summed(frames), board(frames)[:4]
    for as_of in (NOW, "2024-01-10", "2023-12-20 00:30:00"):
        assert same(
            reports.search_board(frames["patient"], *others, readings, as_of),
            reports.patient_search(frames["patient"], *board(frames), as_of),
        )
    assert same(
        reports.coach_board(frames["patient"], frames["coach"], *others, readings, "Kim", NOW, distinct=False),
        reports.coach_queue(frames["patient"], frames["coach"], *board(frames), "Kim", NOW, distinct=False),
    )


def test_study_over_summaries(world):  # noqa: F811
    frames, _ = world
    days = summed(frames).days
    kinds = [summaries.readings_of(days, kind) for kind in ("glucose", "pressure")]
    raw = [frames["glucose_reading"], frames["blood_pressure_reading"]]
    assert same(
        reports.study_reading_days(frames["device"], *kinds, NOW), reports.study_reading_days(frames["device"], *raw, NOW)
    )


def test_activity_over_summaries(spark, world):  # noqa: F811
    frames, _ = world
    notes = frames["patient_note"].withColumn("note_type_id", F.pmod(F.col("patient_id"), F.lit(3)))
    kinds = schemas.lookup_frame(spark, "note_type_id", schemas.NOTE_TYPES)
    days = summed(frames).days
    raw = activity.activity_scans(
        frames["device"], frames["glucose_reading"], frames["blood_pressure_reading"], notes, kinds, "2024-01-15"
    )
    cut = F.coalesce(F.col("note_datetime") < "2024-01-05 13:00:00", F.lit(False))
    talk = summaries.talk_days(notes.where(cut)).unionByName(summaries.talk_days(notes.where(~cut)))
    short = activity.activity_scans(
        frames["device"], *(summaries.readings_of(days, kind) for kind in ("glucose", "pressure")),
        summaries.notes_of(talk), kinds, "2024-01-15",
    )
    for name in ("glucose_days", "pressure_days", "intro_talk", "month_talk", "last_notes"):
        assert same(getattr(short, name).distinct(), getattr(raw, name).distinct()), name


def test_dashboards_and_fold_read_no_readings(spark, sources, tmp_path):  # noqa: F811
    root = str(tmp_path)
    month.load_month(spark, sources, root, *JANUARY, "2024-02-01 08:00:00")
    code_state = month.run_codes(month.summed_tables(spark, root, sources.note_type), "2024-01-31")
    for frame in (
        dashboards.coach_queue(spark, root, "Alex Coach", "2024-01-20 15:30:00"),
        dashboards.patient_search(spark, root, "2024-01-20 15:30:00", first_name="Bruno"),
        dashboards.study_extract(spark, root, "2024-01-31"),
        month.summed_tables(spark, root, sources.note_type)["glucose_reading"],
        code_state.codes,
    ):
        text = io.StringIO()
        with redirect_stdout(text):
            frame.explain("formatted")
        assert "reading/load=" not in text.getvalue().replace("device_last_reading/load=", "")
        assert "Window" not in text.getvalue() and frame.count() >= 0
    (row,) = dashboards.coach_queue(spark, root, "Alex Coach", "2024-01-20 15:30:00").collect()
    assert row.mon_count == 11 and row.last_reading_date == dt.datetime(2024, 1, 25, 8)


def test_a_load_that_breaks_off_leaves_the_old_month(spark, sources, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path)
    month.load_month(spark, sources, root, *JANUARY, "2024-02-01 08:00:00")
    before = {p for p in tmp_path.rglob("load=*")}
    append = versions.Change.append

    def failing(self, df, table):
        if table == "glucose_reading":
            raise RuntimeError("lost between reset and append")
        append(self, df, table)

    monkeypatch.setattr(versions.Change, "append", failing)
    fewer = replace(sources, glucose_log=sources.glucose_log.limit(1))
    with pytest.raises(RuntimeError, match="between reset"):
        month.load_month(spark, fewer, root, *JANUARY, "2024-02-01 08:00:00")
    assert readers.read_stored(spark, root, "glucose_reading").count() == 16
    assert readers.read_stored(spark, root, "patient").count() == 2
    assert {p for p in tmp_path.rglob("load=*")} == before
    monkeypatch.undo()
    month.load_month(spark, fewer, root, *JANUARY, "2024-02-01 08:00:00")
    assert readers.read_stored(spark, root, "glucose_reading").count() == 1
    # The folders of the version before stay for readers that have begun; older ones go.
    assert {p for p in tmp_path.rglob("load=*")} > before
    month.load_month(spark, sources, root, *JANUARY, "2024-02-01 08:00:00")
    assert not before & {p for p in tmp_path.rglob("load=*")}


def test_a_second_month_adds_to_tables_summaries_and_codes(spark, sources, tmp_path):  # noqa: F811
    root, report = str(tmp_path / "tables"), str(tmp_path / "report")
    code_type = schemas.lookup_frame(spark, "med_code_type_id", schemas.MEDICAL_CODES)
    month.load_month(spark, sources, root, *JANUARY, "2024-02-01 08:00:00")
    month.bill_month(spark, root, sources.note_type, code_type, *JANUARY, report)
    first = readers.read_stored(spark, root, "medical_code").collect()
    days = [dt.datetime(2024, 2, n, 7) for n in range(1, 18)]
    later = replace(
        sources,
        glucose_log=spark.createDataFrame([(1, "GM", day, day, "99", False) for day in days], schemas.SOURCES["glucose_log"]),
        notes_log=spark.createDataFrame([(1, "x", days[5], "Alex Coach", None, 9)], schemas.SOURCES["notes_log"]),
        time_log=spark.createDataFrame(
            [(1, "0:25:00", "Alex Coach", "Follow-up", True, days[5], days[5], 9)], schemas.SOURCES["time_log"]
        ),
    )
    month.extend_month(spark, later, root, "2024-02-01", "2024-02-29")
    assert readers.read_stored(spark, root, "glucose_reading").count() == 33
    last = readers.read_stored(spark, root, "device_last_reading").collect()
    assert [row.last_reading_date for row in last] == [days[-1]]
    month.bill_month(spark, root, sources.note_type, code_type, "2024-02-01", "2024-02-29", report, keep_earlier=True)
    stored = readers.read_stored(spark, root, "medical_code").collect()
    assert {row.med_code_id for row in stored} == set(range(1, len(stored) + 1)) and set(first) < set(stored)
    added = [schemas.MEDICAL_CODES[row.med_code_type_id - 1] for row in set(stored) - set(first)]
    # The device was set up in January; February has its own usage and talk.
    assert sorted(added) == ["99454", "99457"]
