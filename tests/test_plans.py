"""Physical plans: what reaches the scan, what is shuffled, what stays on the JVM."""

import io
import re
from contextlib import redirect_stdout

import pytest

from pulseledger.catalogue.queries import QUERIES


def plan(spark, sf_dir, name):
    text = io.StringIO()
    with redirect_stdout(text):
        QUERIES[name](spark, sf_dir).explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"load_and_bill", "billing_fold_second_run"}))
def test_no_quadratic_joins_and_no_row_python(name, spark, sf_dir):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert not re.search(r"Exchange SinglePartition.*\n.*LocalLimit", text)
    if not re.search("note", name):
        assert "ArrowEvalPython" not in text


@pytest.mark.parametrize(
    ("name", "filters", "columns"),
    [
        ("code_99454_glucose", "GreaterThanOrEqual(ts,2024-01-10T00:00)", {"ts", "user_id", "event_type"}),
        ("code_99457", "GreaterThanOrEqual(ts,2024-01-09T00:00)", {"ts", "user_id", "event_type", "value"}),
        ("patient_overview", "LessThanOrEqual(ts,2024-01-20T15:30)", {"ts", "user_id", "event_type"}),
        ("scan_time_log", "LessThanOrEqual(ts,2024-01-25T00:00)", {"ts", "user_id", "event_type", "event_id"}),
    ],
)
def test_filters_and_columns_reach_the_scan(name, filters, columns, spark, sf_dir):
    text = plan(spark, sf_dir, name)
    scans = [part for part in text.split("\n\n") if "Scan parquet" in part and "events.parquet" in part]
    assert any(filters in scan for scan in scans)
    read = [set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", scan).group(1))) for scan in scans]
    assert columns in read


def test_readings_are_reduced_before_they_are_shuffled(spark, sf_dir):
    text = plan(spark, sf_dir, "code_99453_glucose")
    tree = text.split("\n\n")[0]
    first_exchange_above_scan = tree[: tree.index("events") if "events" in tree else None]
    assert first_exchange_above_scan.count("HashAggregate") >= 2


def test_cleansing_has_no_shuffle(spark, sf_dir):
    for name in ("clean_patients", "constraint_pass", "split_dx", "split_contacts", "clean_bp"):
        assert "Exchange" not in plan(spark, sf_dir, name)
