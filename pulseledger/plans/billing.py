"""The billing run: codes for a month, then the report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from pulseledger.functions.dates import Moment
from pulseledger.operators.activity import Activity, activity_in_one_pass, activity_scans
from pulseledger.operators.codes import CodeState, apply_rules
from pulseledger.operators.reports import billing_report


def _parts(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        tables["device"],
        tables["glucose_reading"],
        tables["blood_pressure_reading"],
        tables["patient_note"],
        tables["note_type"],
    ]


def scanned_activity(tables: Mapping[str, DataFrame], as_of: Moment) -> Activity:
    """Activity for a single rule."""
    return activity_scans(*_parts(tables), as_of)


def shared_activity(tables: Mapping[str, DataFrame], as_of: Moment) -> Activity:
    """Activity for a run of several rules, each big table read once."""
    return activity_in_one_pass(*_parts(tables), as_of)


def run_codes(
    tables: Mapping[str, DataFrame], as_of: Moment, state: CodeState | None = None
) -> CodeState:
    """All standard rules in order, from an empty state unless one is given."""
    activity = shared_activity(tables, as_of)
    start = state if state is not None else CodeState.empty(tables["device"].sparkSession)
    return apply_rules(activity, start, as_of)


def run_billing(
    tables: Mapping[str, DataFrame], start: Moment, end: Moment
) -> tuple[CodeState, DataFrame]:
    """Codes as of ``end`` and the billing report for ``start`` to ``end``."""
    state = run_codes(tables, end)
    report = billing_report(
        tables["patient"],
        tables["patient_address"],
        tables["patient_insurance"],
        tables["medical_necessity"],
        state.codes,
        start,
        end,
    )
    return state, report
