"""Which cleansed patients fit the target tables, and why the others do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.operators.joins import null_safe_join
from pulseledger.session import materialise

# Longest text each target column takes.
MAX_LENGTHS: dict[str, int] = {
    "phone_number": 11,
    "social_security": 9,
    "temp_state": 2,
    "zipcode": 5,
    "emergency_phone_number": 11,
    "emergency_phone_number2": 11,
    "medicare_beneficiary_id": 11,
    "primary_payer_id": 30,
    "secondary_payer_id": 30,
}
# A missing value is measured as the text "None".
NULL_LENGTH = 4


def _length(name: str) -> Column:
    return F.coalesce(F.length(name), F.lit(NULL_LENGTH))


def within_limits(cleansed: DataFrame) -> DataFrame:
    """Patients whose values fit. A missing state is dropped: it measures 4 > 2."""
    fits = None
    for name, limit in MAX_LENGTHS.items():
        short = _length(name) <= limit
        fits = short if fits is None else fits & short
    return _computed_once(cleansed).where(fits)


def _computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with filters on them kept above the computed columns.

    A filter is otherwise moved below the projection it reads and computes the
    cleansed values a second time. It cannot be moved below a generator.
    """
    row = F.struct(*(F.col(f"`{name}`") for name in df.columns))
    return df.select(F.inline(F.array(row)))


def rejects(cleansed: DataFrame) -> DataFrame:
    """One row per patient and broken expectation, with ``error_type`` in front.

    The cleansed rows are stored first, so that they are computed once for the
    counts and the checks. Duplicates are found from grouped counts joined back,
    so a name shared by very many rows is never gathered in one task.
    """
    cleansed = materialise(cleansed)
    identity = ("first_name", "last_name", "date_of_birth")
    repeated = (
        cleansed.groupBy(*identity)
        .agg((F.count(F.lit(1)) > 1).alias("repeated"))
        .where("repeated")
    )

    def unless_length(name: str, exact: int, error: str) -> Column:
        return F.when(_length(name) != exact, error)

    def too_long(name: str, error: str) -> Column:
        return F.when(_length(name) >= 30, error)

    errors = F.array(
        unless_length("phone_number", 11, "phone number length error"),
        unless_length("social_security", 9, "social security length error"),
        unless_length("zipcode", 5, "zipcode length error"),
        unless_length("emergency_phone_number", 11, "emergency phone number length error"),
        unless_length("emergency_phone_number2", 11, "second emergency phone number length error"),
        unless_length("medicare_beneficiary_id", 11, "medicare beneficiary id length error"),
        too_long("primary_payer_id", "primary payer id length error"),
        too_long("secondary_payer_id", "secondary payer id length error"),
        F.when(
            F.col("primary_payer_id").isNull() & F.col("primary_payer_name").isNull(),
            "missing insurance information",
        ),
        F.when(F.col("repeated"), "duplicate patient"),
    )
    checked = null_safe_join(cleansed, repeated, identity, "left")
    failed = checked.select(F.explode(F.array_compact(errors)).alias("error_type"), "*")
    return failed.drop("repeated")
