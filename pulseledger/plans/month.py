"""Months from landed sources to stored tables, summaries, codes and reports.

The tables under a root are versioned (``sources.versions``): whatever breaks
off, readers find the tables of the last run that came to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseledger.functions.dates import Moment
from pulseledger.operators import keys, normalize, summaries
from pulseledger.operators.codes import CodeState, code_tables
from pulseledger.plans.billing import run_codes
from pulseledger.plans.load import RawSources, link_author, link_note_type, load_tables, staged_notes
from pulseledger.operators.reports import billing_report
from pulseledger.schemas import CODE_TABLES, SUMMARIES, TARGETS
from pulseledger.session import materialise, scratch
from pulseledger.sources import readers
from pulseledger.sources.readers import read_stored
from pulseledger.sources.versions import Change, change
from pulseledger.sources.writers import write_report

READING_TABLES = ("glucose_reading", "blood_pressure_reading")


def add_activity(new: Change) -> None:
    """Add the readings and notes that a change has written to the stored summaries.

    Only those rows are read. Per device the latest reading is merged.
    """
    days = summaries.reading_days(*(new.stored(name, new=True) for name in READING_TABLES))
    new.append(days, "reading_day")
    added = new.stored("reading_day", new=True)
    new.replace(
        summaries.merged_last_readings(new.stored("device_last_reading"), added), "device_last_reading"
    )
    new.append(summaries.talk_days(new.stored("patient_note", new=True)), "talk_day")


def load_month(
    spark: SparkSession,
    sources: RawSources,
    root: str,
    start: Moment,
    end: Moment,
    loaded_at: Moment,
    snapshots: str | None = None,
) -> None:
    """Replace the target tables and summaries under ``root`` by what the sources hold.

    All tables change together, once everything is written.
    """
    with scratch(spark), change(spark, root) as new:
        loaded = load_tables(sources, start, end, loaded_at, snapshots)
        new.reset([*TARGETS, *SUMMARIES])
        for name, rows in loaded.items():
            new.append(rows, name)
        add_activity(new)


def extend_month(
    spark: SparkSession, sources: RawSources, root: str, start: Moment, end: Moment
) -> None:
    """Add the readings and notes of a further range to the stored tables and summaries.

    They are filed under the stored patients and devices; those, the codes and
    everything stored before stay as they are. No stored reading is read.
    """
    with scratch(spark), change(spark, root) as new:
        patient, device, user = (read_stored(spark, root, name) for name in ("patient", "device", "user"))
        glucose = normalize.normalize_bg_readings(readers.glucose_window(sources.glucose_log, start, end))
        pressure = normalize.normalize_bp_readings(readers.pressure_window(sources.pressure_log, start, end))
        new.append(keys.resolve_readings(glucose, patient, device), "glucose_reading")
        new.append(keys.resolve_readings(pressure, patient, device), "blood_pressure_reading")
        notes = keys.resolve_notes(staged_notes(sources.notes_log, sources.time_log, start, end), patient)
        new.append(link_author(link_note_type(notes, sources.note_type), user), "patient_note")
        add_activity(new)


def summed_tables(spark: SparkSession, root: str, note_type: DataFrame) -> dict[str, DataFrame]:
    """What the billing rules read, from the stored summaries."""
    days, talk = read_stored(spark, root, "reading_day"), read_stored(spark, root, "talk_day")
    return {
        "device": read_stored(spark, root, "device"),
        "glucose_reading": summaries.readings_of(days, "glucose"),
        "blood_pressure_reading": summaries.readings_of(days, "pressure"),
        "patient_note": summaries.notes_of(talk),
        "note_type": note_type,
    }


def bill_month(
    spark: SparkSession,
    root: str,
    note_type: DataFrame,
    code_type: DataFrame,
    start: Moment,
    end: Moment,
    report_path: str,
    report_format: str = "csv",
    keep_earlier: bool = False,
) -> None:
    """Code the stored tables as of ``end``; then store the codes and the report.

    The rules read the summaries, never the readings. The codes of earlier
    months are replaced, unless ``keep_earlier``: then the run starts from them
    and adds its own, with ids that follow theirs.
    """
    tables = summed_tables(spark, root, note_type)
    with scratch(spark), change(spark, root) as new:
        if not keep_earlier:
            new.reset(CODE_TABLES)
        stored = [new.stored(name) for name in ("medical_code", "medical_code_device")]
        earlier = CodeState.stored(*stored, code_type) if keep_earlier else None
        state = run_codes(tables, end, earlier)
        codes, links = (materialise(rows) for rows in code_tables(state, code_type, stored[0]))
        new.append(codes, "medical_code")
        new.append(links, "medical_code_device")
        parts = ("patient", "patient_address", "patient_insurance", "medical_necessity")
        report = billing_report(
            *(read_stored(spark, root, name) for name in parts), state.codes, start, end
        )
        write_report(report, report_path, report_format)
