"""Equality joins in which a null key matches a null key, with salting by fixed or measured shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.session import materialise

_SALT = "__salt"
# A key is split as soon as it holds more than this part of an average task's rows.
_PIECES = 8


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str = "inner",
    salt: int = 1,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join on ``keys``; the result has the left keys and the right side's other columns.

    ``salt`` > 1 spreads the rows of every left key over that many partitions and
    repeats the (narrow) right side as often. Use it where one key may hold a
    large share of a big left side; rows and results do not change. A row's salt
    comes from its input partition and its values in the ``spread`` columns: a
    task run again after a lost executor gives the same salts, and equal rows
    from different partitions still part.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    renamed = right.select(
        *(
            F.col(f"`{name}`").alias(f"__key_{name}" if name in names else name)
            for name in right.columns
        )
    )
    if salt > 1:
        place = F.xxhash64(F.spark_partition_id(), *(F.col(name) for name in spread))
        left = left.withColumn(_SALT, F.pmod(place, F.lit(salt)))
        salts = F.explode(F.array(*(F.lit(n).cast("bigint") for n in range(salt))))
        renamed = renamed.withColumn(f"__key_{_SALT}", salts)
        names = [*names, _SALT]
    same = None
    for name in names:
        equal = F.col(name).eqNullSafe(F.col(f"__key_{name}"))
        same = equal if same is None else same & equal
    joined = left.join(renamed, same, how)
    return joined.drop(*(f"__key_{name}" for name in names), _SALT)


def heavy_keys(df: DataFrame, key: Column) -> DataFrame:
    """``heavy, copies`` of the keys (null among them) that hold more than their share of the rows.

    Read with the key column alone and counted before the shuffle. A key's share
    is an eighth of what an average task gets, so there are at most eight such
    keys per shuffle partition, however large the input: the table is small.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(df.select(key.alias("heavy")).groupBy("heavy").agg(F.count(F.lit(1)).alias("n")))
    share = counts.agg(F.ceil(F.sum("n") / (tasks * _PIECES)).cast("bigint")).scalar()
    heavy = counts.where(F.col("n") > share)
    return materialise(heavy.select("heavy", F.ceil(F.col("n") / share).cast("bigint").alias("copies")))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: str,
    how: str,
    null_safe: bool,
    spread: Sequence[Column] = (),
) -> DataFrame:
    """Join in which the rows of a heavy left key meet copies of the right side in several tasks.

    The heavy keys and their copies follow from the counts; every other key has
    one. All columns of both sides stay, but for the helpers.
    """
    heavy = heavy_keys(left, left_key)
    # Bounded by the number of shuffle partitions, see ``heavy_keys``.
    known = F.broadcast(heavy)
    place = F.xxhash64(F.spark_partition_id(), *spread)
    copies = F.coalesce("copies", F.lit(1).cast("bigint"))
    salted = (
        left.join(known, left_key.eqNullSafe(F.col("heavy")), "left")
        .withColumn(_SALT, F.pmod(place, copies))
        .drop("heavy", "copies")
    )
    numbers = F.sequence(F.lit(0).cast("bigint"), copies - 1)
    copied = (
        right.join(known, F.col(right_key).eqNullSafe(F.col("heavy")), "left")
        .withColumn("__copy", F.explode(numbers))
        .drop("heavy", "copies")
    )
    found = F.col(right_key)
    same = left_key.eqNullSafe(found) if null_safe else left_key == found
    return salted.join(copied, same & (F.col(_SALT) == F.col("__copy")), how).drop(_SALT, "__copy")


def comparable(col: Column, collation: str | None) -> Column:
    """The text as it is compared: byte by byte, or under a collation.

    ``UTF8_LCASE_RTRIM`` ignores case and trailing blanks, as many database
    servers do by default.
    """
    return col if collation is None else F.collate(col, collation)
