"""How the sources are cut into tasks, and what a date cell costs."""

import io
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from pulseledger.catalogue.queries import QUERIES
from pulseledger.operators import normalize
from pulseledger.sources import readers

ROWS = 2 * readers.ROWS_PER_TASK + 1


@pytest.fixture(scope="module")
def one_piece(spark, tmp_path_factory):
    """Customers in one file of one row group; some come twice, some without a key."""
    folder = tmp_path_factory.mktemp("large")
    key = F.when(F.col("id") % 1000 != 7, F.col("id") - F.col("id") % 500 % 2)
    customers = spark.range(0, ROWS, 1, 1).select(
        key.alias("c_custkey"), F.concat(F.lit("Customer#"), key).alias("c_name")
    )
    customers.write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def pieces(df):
    return [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]


def test_a_source_in_one_row_group_is_cleansed_in_several_tasks(spark, one_piece):
    assert max(pieces(spark.read.parquet(f"{one_piece}/customer.parquet"))) == ROWS
    for name in ("clean_patients", "constraint_pass", "split_patient"):
        placed = QUERIES[name](spark, one_piece).select(F.spark_partition_id().alias("place"))
        assert placed.distinct().count() == 3
    sizes = pieces(QUERIES["clean_patients"](spark, one_piece))
    assert sum(sizes) == ROWS and max(sizes) < readers.ROWS_PER_TASK


def test_dealing_out_keeps_every_row(spark, one_piece):
    given = spark.read.parquet(f"{one_piece}/customer.parquet")
    dealt = readers.in_even_pieces(given, 1000)
    sizes = pieces(dealt)
    assert len(sizes) == 51 and max(sizes) <= 1100
    assert Counter(dealt.collect()) == Counter(given.collect())


def test_small_and_empty_sources_stay_as_they_are(spark, one_piece):
    given = spark.read.parquet(f"{one_piece}/customer.parquet")
    for frame in (given.limit(0), spark.range(0, 100, 1, 4), given.where("c_custkey < 0")):
        assert readers.in_even_pieces(frame, 30) is frame


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("1/5/2023 1:02:03 PM", "2023-01-05 13:02:03"),
        ("1/5/2023 12:00 pm", "2023-01-05 12:00:00"),
        ("1/5/2023 0:07", "2023-01-05 00:07:00"),
        ("1/5/2023 AM", None),
        ("1/5/2023 10:60", None),
        ("0/5/2023", None),
        ("1/5/0000", None),
    ],
)
def test_date_cells_with_parts_of_a_time(spark, cell, expected):
    frame = spark.createDataFrame([(cell,)], "cell string")
    day = frame.select(normalize.parsed_timestamp(F.col("cell")).cast("string").alias("day")).first().day
    assert day == expected


def test_no_part_of_a_date_cell_is_cast_to_fail(spark):
    """A cast of an empty part throws and catches an exception, for every row."""
    text = io.StringIO()
    with redirect_stdout(text):
        frame = spark.createDataFrame([("1/5/2023",)], "cell string")
        frame.select(normalize.parsed_timestamp(F.col("cell"))).explain(True)
    assert "as timestamp_ntz" in text.getvalue() and "as int" in text.getvalue()
    assert "try_cast(get(" not in text.getvalue().lower()
