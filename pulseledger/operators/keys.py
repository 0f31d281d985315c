"""Key resolution: external ids to surrogate ids, names to lookup ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseledger.operators.joins import comparable, null_safe_join, spread_join
from pulseledger.session import materialise

# A look-up of up to so many bytes is sent to every task; a larger one is shuffled.
SMALL_LOOKUP = 8 << 20


def add_id_column(
    df: DataFrame, ids: DataFrame, key: str, salt: int = 1, spread: Sequence[str] = ()
) -> DataFrame:
    """Swap ``key`` for the ids found under it.

    Rows without an id are lost, rows with several ids are repeated, and a null
    key finds the ids filed under null.
    """
    return null_safe_join(df, ids, key, salt=salt, spread=spread).drop(key)


def add_id_to_facts(facts: DataFrame, ids: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """``add_id_column`` for readings and notes, of which one key may hold most rows.

    Their keys are counted first; the rows of a heavy one are dealt out over as
    many tasks as its share asks for.
    """
    found = ids.select(*(F.col(f"`{name}`").alias("__key" if name == key else name) for name in ids.columns))
    places = [F.col(name) for name in spread]
    return spread_join(facts, found, F.col(key), "__key", "inner", True, places).drop("__key", key)


def patient_keys(patient: DataFrame) -> DataFrame:
    return patient.select("patient_id", "sharepoint_id")


def resolve_to_patient(df: DataFrame, patient: DataFrame) -> DataFrame:
    """Address, insurance, diagnosis, status or contact rows under ``patient_id``."""
    return add_id_column(df, patient_keys(patient), "sharepoint_id")


def resolve_notes(notes: DataFrame, patient: DataFrame) -> DataFrame:
    return add_id_to_facts(notes, patient_keys(patient), "sharepoint_id", ["note_datetime"])


def resolve_devices(devices: DataFrame, patient: DataFrame, vendor: DataFrame) -> DataFrame:
    """Devices under ``patient_id`` and ``vendor_id``."""
    vendors = vendor.select("vendor_id", F.col("name").alias("Vendor"))
    return add_id_column(resolve_to_patient(devices, patient), vendors, "Vendor")


def resolve_readings(readings: DataFrame, patient: DataFrame, device: DataFrame) -> DataFrame:
    """Readings under ``device_id``, copied to every device of their patient.

    Patient and device keys are joined with each other first (both are small
    beside the readings), so the readings themselves are shuffled once.
    """
    owned = add_id_column(device.select("device_id", "patient_id"), patient_keys(patient), "patient_id")
    return add_id_to_facts(readings, owned, "sharepoint_id", ["received_datetime"])


def lookup_id(
    df: DataFrame,
    lookup: DataFrame,
    name_column: str,
    id_column: str,
    lookup_name: str = "name",
    collation: str | None = None,
    small: int = SMALL_LOOKUP,
) -> DataFrame:
    """Fill ``id_column`` from the lookup row whose name equals ``name_column``.

    A name that is not listed gives null, a row without a name keeps the id it
    has, and a name listed more than once is an error as soon as a row uses it.
    A lookup that measures up to ``small`` bytes is sent to every task, so that
    the rows stay where they are. A larger one meets them by a shuffle, in which
    the rows of a heavy name, or of none, are dealt out over several tasks.
    """
    listed = lookup.groupBy(comparable(F.col(lookup_name), collation).alias("__name")).agg(
        F.min(id_column).alias("__id"), F.count(F.lit(1)).alias("__listed")
    )
    name = comparable(F.col(name_column), collation)
    # A name, its id and count, and the place they take in a hash table.
    (size,) = lookup.agg(F.sum(F.coalesce(F.octet_length(lookup_name), F.lit(0)) + 64)).first()
    if (size or 0) <= small:
        joined = df.join(F.broadcast(listed), name == F.col("__name"), "left")
    else:
        places = [F.col(f"`{column}`") for column in df.columns]
        joined = spread_join(df, listed, name, "__name", "left", False, places)
    ambiguous = F.raise_error(F.concat(F.lit("more than one lookup row named "), F.col(name_column)))
    found = F.when(F.col("__listed") > 1, ambiguous.cast("bigint")).otherwise(F.col("__id"))
    if id_column in df.columns:
        found = F.when(F.col(name_column).isNull(), F.col(id_column)).otherwise(found)
    return joined.withColumn(id_column, found).drop("__name", "__id", "__listed")


def assign_ids(
    df: DataFrame, id_column: str, order: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Consecutive ids in the order of ``order``, after the largest existing id.

    The rows are range-sorted and stored with their partition and their place in
    it; the ids then follow from the partitions' row counts. Only one row per
    partition (its count) is ever brought together.
    """
    position = F.monotonically_increasing_id()
    placed = materialise(
        df.orderBy(*order)
        .select("*", position.alias("__position"))
        .select(
            "*",
            F.shiftright("__position", 33).alias("__partition"),
            F.col("__position").bitwiseAND(F.lit((1 << 33) - 1)).alias("__place"),
        )
        .drop("__position")
    )
    counts = placed.groupBy("__partition").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__partition", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset")
    )
    start = F.lit(0).cast("bigint")
    if existing is not None:
        largest = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint"))
        start = largest.scalar()
    numbered = placed.join(offsets, "__partition")
    new_id = (start + F.col("__offset") + F.col("__place") + 1).alias(id_column)
    return numbered.select(new_id, *df.columns)
