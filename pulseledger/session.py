"""Session settings and intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "pulseledger", **settings: str) -> SparkSession:
    """A session with the settings the library is written for.

    The master, memory and shuffle partition count belong to the cluster; pass
    them in ``settings`` where the launcher does not set them.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder intermediate tables are written to.

    ``spark.checkpoint.dir`` names the shared folder. Only a session within one
    process that has no such setting (a notebook) uses a folder in its warehouse;
    everywhere else the missing setting is an error.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is None:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/pulseledger-intermediate"


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the intermediate tables stored within the block when it ends.

    Results that read them must be written before. The folders so far are given,
    in the order of storing; one taken out of the list stays.
    """
    stored: list[str] = []
    token = _scopes.set((*_scopes.get(), stored))
    try:
        yield stored
    finally:
        _scopes.reset(token)
        delete_folders(spark, stored)


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    conf = spark._jsc.hadoopConfiguration()
    for name in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from a table in the shared folder.

    That cuts the lineage and survives lost executors. Parquet keeps the table
    small, lets every reader prune columns and filter row groups, and gives the
    optimizer the real size for its join choices. Within ``scratch`` the table
    goes when the block ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/pulseledger-{uuid.uuid4().hex}"
    for stored in _scopes.get()[-1:]:
        stored.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
