"""Tables whose changes take effect together, by one switch.

Rows are written to new folders. The table ``_versions`` under the root lists,
for every version, the folders (one per load) that make up each table. A change adds one file
to it, with a version one higher; until that file is there, readers see the
version before, and a change that breaks off leaves nothing but folders that no
version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger.functions.dates import Moment, moment
from pulseledger.schemas import MONTH_OF, empty_frame, stored_columns
from pulseledger.session import delete_folders
from pulseledger.sources.writers import write_rows

_LOAD = "load="
_COLUMNS = "version bigint, table string, folders array<string>"
# Versions whose folders are kept, for readers that started before a switch.
KEPT_VERSIONS = 2


def _versions(spark: SparkSession, root: str, latest: int) -> dict[int, dict[str, list[str]]]:
    """The latest versions: a few rows, one per table."""
    try:
        listed = spark.read.schema(_COLUMNS).parquet(f"{root}/_versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = listed.agg(F.max("version").alias("last"))
    found: dict[int, dict[str, list[str]]] = {}
    for row in listed.join(last, F.col("version") > F.col("last") - latest).collect():
        found.setdefault(row.version, {})[row.table] = [f"{root}/{name}" for name in row.folders]
    return found


def current_folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders of each table in the current version; empty if there is none yet."""
    found = _versions(spark, root, 1)
    return found[max(found)] if found else {}


def read_folders(
    spark: SparkSession, folders: Sequence[str], table: str, since: Moment | None = None
) -> DataFrame:
    """The rows of a table in the given folders; see ``readers.read_stored``."""
    column, declared = MONTH_OF.get(table), stored_columns(table)
    if not folders:
        return empty_frame(spark, declared)
    parts = ", load string" + ("" if column is None else ", month string")
    # Folders of one versioned table lie side by side; a plain table is its own base.
    base = folders[0].partition(f"/{_LOAD}")[0]
    rows = spark.read.schema(declared + parts).option("basePath", base).parquet(*folders)
    if column is not None and since is not None:
        first = F.date_format(moment(since), "yyyy-MM")
        rows = rows.where((F.col("month") >= first) & (F.col(column) >= moment(since)))
    return rows.drop("load", "month")


class Change:
    """Writes that take effect when the block of ``change`` ends."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root
        self._tables = {name: list(folders) for name, folders in current_folders(spark, root).items()}
        self._written: dict[str, list[str]] = {}
        self.folders: list[str] = []

    def reset(self, tables: Iterable[str]) -> None:
        """Empty the tables."""
        for table in tables:
            self._tables[table] = []
            self._written.pop(table, None)

    def append(self, df: DataFrame, table: str) -> None:
        folder = f"{self._root}/{table}/{_LOAD}{uuid.uuid4().hex}"
        self.folders.append(folder)
        self._written.setdefault(table, []).append(folder)
        write_rows(df, table, folder, "errorifexists")
        self._tables.setdefault(table, []).append(folder)

    def replace(self, df: DataFrame, table: str) -> None:
        """The rows become the whole table; they may be made from the table as it was."""
        self.append(df, table)
        self._tables[table] = self._tables[table][-1:]

    def stored(self, table: str, new: bool = False) -> DataFrame:
        """The table as this change leaves it so far; with ``new`` only what it has written."""
        folders = (self._written if new else self._tables).get(table, [])
        return read_folders(self._spark, folders, table)

    def _switch(self) -> None:
        before = _versions(self._spark, self._root, KEPT_VERSIONS)
        start = len(self._root) + 1
        rows = [
            (max(before, default=0) + 1, table, [folder[start:] for folder in folders])
            for table, folders in sorted(self._tables.items())
        ]
        # One file, so that its appearance is the switch.
        listed = self._spark.createDataFrame(rows, _COLUMNS).coalesce(1)
        listed.write.mode("append").parquet(f"{self._root}/_versions")
        if len(before) == KEPT_VERSIONS:
            kept = {f for tables in [before[max(before)], self._tables] for fs in tables.values() for f in fs}
            old = {f for folders in before[min(before)].values() for f in folders}
            delete_folders(self._spark, sorted(old - kept))


@contextmanager
def change(spark: SparkSession, root: str) -> Iterator[Change]:
    """A change of the tables under ``root``, by one writer at a time.

    All of it takes effect at the end of the block; if the block fails, nothing
    does, and what it wrote is deleted. Folders that only versions before the
    last one name are deleted after the switch.
    """
    changing = Change(spark, root)
    try:
        yield changing
    except BaseException:
        delete_folders(spark, changing.folders)
        raise
    changing._switch()
