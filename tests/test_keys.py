"""Joins with null keys, lookups by name, surrogate ids."""

import pytest
from pyspark.sql import functions as F

from pulseledger.operators import keys
from pulseledger.operators.joins import heavy_keys, null_safe_join
from pulseledger.plans import load


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def test_key_is_swapped_for_the_id(spark):
    people = spark.createDataFrame([("John Doe", 30)], "name string, age int")
    ids = spark.createDataFrame([("John Doe", 1)], "name string, id bigint")
    result = keys.add_id_column(people, ids, "name")
    assert result.columns == ["age", "id"] and rows(result, "age", "id") == [(30, 1)]


@pytest.mark.parametrize("salt", [1, 5])
def test_unmatched_lost_several_ids_repeat_null_matches_null(spark, salt):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k bigint, v string")
    ids = spark.createDataFrame([(1, 10), (1, 11), (None, 99), (3, 30)], "k bigint, id bigint")
    result = keys.add_id_column(left, ids, "k", salt=salt)
    expected = [("a", 10), ("a", 10), ("a", 11), ("a", 11), ("c", 99)]
    assert rows(result, "v", "id") == sorted(expected, key=repr)


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    hot = spark.range(9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v")
    )
    ids = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "k bigint, id bigint")
    plain = null_safe_join(hot, ids, "k").groupBy("id").count()
    for spread in ((), ("k",)):
        salted = null_safe_join(hot, ids, "k", salt=4, spread=spread).groupBy("id").count()
        assert rows(plain, "id", "count") == rows(salted, "id", "count")


def test_lookup_by_name(spark):
    notes = spark.createDataFrame(
        [(1, "Alert", None), (2, "Other", 5), (3, None, 7), (4, None, None)],
        "n int, temp_note_type string, note_type_id bigint",
    )
    types = spark.createDataFrame([(1, "Alert"), (2, "Follow-up")], "note_type_id bigint, name string")
    result = load.link_note_type(notes, types)
    assert rows(result, "n", "note_type_id") == [(1, 1), (2, None), (3, 7), (4, None)]


def test_ambiguous_lookup_fails_only_when_used(spark):
    types = spark.createDataFrame([(1, "Alert"), (2, "Alert"), (3, "Ok")], "note_type_id bigint, name string")
    fine = spark.createDataFrame([(1, "Ok")], "n int, temp_note_type string")
    assert rows(load.link_note_type(fine, types), "n", "note_type_id") == [(1, 3)]
    bad = spark.createDataFrame([(1, "Alert")], "n int, temp_note_type string")
    with pytest.raises(Exception, match="more than one lookup row named Alert"):
        load.link_note_type(bad, types).collect()


def test_readings_are_copied_to_every_device_of_the_patient(spark):
    patient = spark.createDataFrame([(1, 101), (2, 102)], "patient_id bigint, sharepoint_id bigint")
    device = spark.createDataFrame([(11, 1), (12, 1), (21, 2)], "device_id bigint, patient_id bigint")
    readings = spark.createDataFrame(
        [(101, 5.0), (102, 6.0), (103, 7.0)], "sharepoint_id bigint, v double"
    ).withColumn("received_datetime", F.lit(None).cast("timestamp_ntz"))
    result = keys.resolve_readings(readings, patient, device)
    assert set(result.columns) == {"v", "received_datetime", "device_id"}
    assert rows(result, "device_id", "v") == [(11, 5.0), (12, 5.0), (21, 6.0)]


def test_ids_are_consecutive_in_order_and_continue(spark):
    frame = spark.range(1000, numPartitions=7).select((999 - F.col("id")).alias("k"))
    existing = spark.createDataFrame([(41,), (7,)], "row_id bigint")
    result = keys.assign_ids(frame, "row_id", ["k"], existing)
    assert rows(result, "k", "row_id") == sorted([(k, 42 + k) for k in range(1000)], key=repr)
    assert rows(keys.assign_ids(frame.where("k < 3"), "row_id", ["k"]), "row_id") == [(1,), (2,), (3,)]


def test_ids_for_no_rows(spark):
    assert keys.assign_ids(spark.range(0), "row_id", ["id"]).count() == 0


def largest_share(df):
    """The largest task's rows as a multiple of the mean, over the tasks of the join."""
    sizes = [row["count"] for row in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(sizes) * len(sizes) / sum(sizes)


@pytest.mark.parametrize("small", [0, keys.SMALL_LOOKUP])
@pytest.mark.parametrize("hot", ["'author 1'", "cast(null as string)"])
def test_rows_of_a_hot_name_are_spread(spark, hot, small):
    notes = spark.range(0, 200_000, 1, 8).selectExpr(
        "id AS n", f"if(id % 2 = 0, {hot}, concat('author ', id % 50)) AS author"
    )
    users = spark.range(50).selectExpr("id AS user_id", "concat('author ', id) AS name")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = keys.lookup_id(notes, users, "author", "user_id", small=small)
        assert largest_share(found) < 2
        assert found.count() == 200_000 and found.where("user_id is not null").count() >= 100_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_copies_of_a_large_lookup_follow_from_the_counts(spark):
    rows_of = spark.range(0, 10_000, 1, 4).selectExpr("if(id < 5000, 'many', concat('few ', id)) AS name")
    heavy = {row.heavy: row.copies for row in heavy_keys(rows_of, F.col("name")).collect()}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(heavy) == {"many"} and heavy["many"] == pytest.approx(4 * tasks, abs=1)
    assert heavy_keys(rows_of.limit(0), F.col("name")).count() == 0


@pytest.mark.parametrize("small", [0, keys.SMALL_LOOKUP])
def test_large_and_small_lookups_agree(spark, small):
    notes = spark.createDataFrame([("a ",), ("A",), ("b",), (None,), ("c",)] * 40, "author string")
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "z")], "user_id bigint, name string")
    found = keys.lookup_id(notes, users, "author", "user_id", collation="UTF8_LCASE_RTRIM", small=small)
    assert rows(found.distinct(), "author", "user_id") == sorted(
        [("a ", 1), ("A", 1), ("b", 2), (None, None), ("c", None)], key=repr
    )
    assert found.count() == 200
    assert keys.lookup_id(notes, users.limit(0), "author", "user_id", small=small).where("user_id is null").count() == 200


def test_half_the_readings_on_one_patient_are_spread(spark):
    patient = spark.range(40).selectExpr("id AS patient_id", "if(id = 39, null, id + 100) AS sharepoint_id")
    device = spark.range(40).selectExpr("id AS device_id", "id AS patient_id")
    readings = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 2 = 0, if(id % 4 = 0, 107, null), 100 + id % 38) AS sharepoint_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS received_datetime",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = keys.resolve_readings(readings, patient, device)
        assert largest_share(found) < 2 and found.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookup_under_a_collation(spark):
    status = spark.createDataFrame([(1, "ALERT "), (2, "alert"), (3, "other")], "n int, kind string")
    types = spark.createDataFrame([(1, "Alert")], "type_id bigint, name string")
    exact = keys.lookup_id(status, types, "kind", "type_id")
    assert rows(exact, "n", "type_id") == [(1, None), (2, None), (3, None)]
    loose = keys.lookup_id(status, types, "kind", "type_id", collation="UTF8_LCASE_RTRIM")
    assert rows(loose, "n", "type_id") == [(1, 1), (2, 1), (3, None)]
