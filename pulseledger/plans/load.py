"""The load run: landed sources to keyed target tables.

The cleansed export and the rows that get surrogate keys are computed at once
and kept (see ``keys.assign_ids``); everything else is computed when the tables
are written or queried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pulseledger.functions.dates import Moment
from pulseledger.operators import entities, keys, normalize, quality
from pulseledger.schemas import conform
from pulseledger.session import materialise
from pulseledger.sources import readers
from pulseledger.sources.writers import write_snapshots


@dataclass(frozen=True)
class RawSources:
    """The landed sources and the seeded lookups."""

    directory: DataFrame
    patient_export: DataFrame
    fulfillment: DataFrame
    glucose_log: DataFrame
    pressure_log: DataFrame
    notes_log: DataFrame
    time_log: DataFrame
    vendor: DataFrame
    note_type: DataFrame
    patient_status_type: DataFrame


def staged_patients(export: DataFrame, loaded_at: Moment) -> dict[str, DataFrame]:
    """The export cleansed, checked and split into the six patient entities.

    The cleansed export is kept, so that it is computed once for all six.
    """
    accepted = materialise(quality.within_limits(normalize.normalize_patients(export)))
    return {
        "patient": entities.patients(accepted),
        "patient_address": entities.addresses(accepted),
        "patient_insurance": entities.insurances(accepted),
        "medical_necessity": entities.medical_necessities(accepted),
        "patient_status": entities.statuses(accepted, loaded_at),
        "emergency_contact": entities.emergency_contacts(accepted),
    }


def staged_notes(notes_log: DataFrame, time_log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Notes and call times of the range, merged and cleansed."""
    return normalize.normalize_patient_notes(
        normalize.merge_notes(
            readers.notes_window(notes_log, start, end), readers.time_window(time_log, start, end)
        )
    )


def load_tables(
    sources: RawSources,
    start: Moment,
    end: Moment,
    loaded_at: Moment,
    snapshots: str | None = None,
    collation: str | None = None,
) -> dict[str, DataFrame]:
    """All target tables for the sources in the date range.

    ``collation`` is how names are compared with the lookups (see
    ``joins.comparable``).

    With ``snapshots`` the staged frames are also written to that folder: users,
    patient entities, devices and notes after cleansing, readings before it.
    """
    staged_users = normalize.normalize_users(sources.directory)
    users = keys.assign_ids(staged_users, "user_id", ["ms_entra_id"])
    staged = staged_patients(sources.patient_export, loaded_at)
    patient = keys.assign_ids(staged["patient"], "patient_id", ["sharepoint_id", "full_name"])
    tables = {
        name: keys.resolve_to_patient(frame, patient)
        for name, frame in staged.items()
        if name != "patient"
    }
    staged_devices = normalize.normalize_devices(readers.supplied_devices(sources.fulfillment))
    devices = keys.resolve_devices(staged_devices, patient, sources.vendor)
    device = keys.assign_ids(devices, "device_id", ["patient_id", "hardware_uuid", "name"])
    raw_glucose = readers.glucose_window(sources.glucose_log, start, end)
    raw_pressure = readers.pressure_window(sources.pressure_log, start, end)
    glucose = normalize.normalize_bg_readings(raw_glucose)
    pressure = normalize.normalize_bp_readings(raw_pressure)
    merged_notes = staged_notes(sources.notes_log, sources.time_log, start, end)
    notes = keys.resolve_notes(merged_notes, patient)
    if snapshots is not None:
        write_snapshots(
            {
                "user": staged_users,
                **staged,
                "device": staged_devices,
                "note": merged_notes,
                "glucose": raw_glucose,
                "blood_pressure": raw_pressure,
            },
            snapshots,
        )
    tables |= {
        "user": users,
        "patient": link_coach(patient, users, collation),
        "patient_status": link_status_type(
            tables["patient_status"], sources.patient_status_type, collation
        ),
        "device": device,
        "glucose_reading": keys.resolve_readings(glucose, patient, device),
        "blood_pressure_reading": keys.resolve_readings(pressure, patient, device),
        "patient_note": link_author(
            link_note_type(notes, sources.note_type, collation), users, collation
        ),
    }
    return {name: conform(frame, name) for name, frame in tables.items()}


# --- lookups by name -----------------------------------------------------------


def link_note_type(
    notes: DataFrame, note_type: DataFrame, collation: str | None = None
) -> DataFrame:
    return keys.lookup_id(
        notes, note_type, "temp_note_type", "note_type_id", collation=collation
    )


def link_status_type(
    status: DataFrame, status_type: DataFrame, collation: str | None = None
) -> DataFrame:
    return keys.lookup_id(
        status, status_type, "temp_status_type", "patient_status_type_id", collation=collation
    )


def link_coach(patient: DataFrame, user: DataFrame, collation: str | None = None) -> DataFrame:
    return keys.lookup_id(patient, user, "temp_user", "user_id", "display_name", collation)


def link_author(notes: DataFrame, user: DataFrame, collation: str | None = None) -> DataFrame:
    return keys.lookup_id(notes, user, "temp_user", "user_id", "display_name", collation)
