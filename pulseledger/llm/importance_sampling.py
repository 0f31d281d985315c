"""Resample documents towards a target distribution by hashed n-gram importance weights.

Features are word n-grams, hashed to a fixed number of buckets. A bucket's gain
is the log of its smoothed share among the target's features over its share
among the documents'; a document's weight is the sum of its features' gains.
Gumbel noise drawn from the id turns the highest weights into a sample without
replacement. Texts are counted and scored whole by Arrow kernels: lower-cased,
split, flattened, dictionary-encoded; only distinct words (or shifted pairs,
triples ... of their indices) are hashed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import numbered_within
from pulseledger.session import materialise

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Everything but digits, small letters and what lies beyond ASCII parts words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bytes of text that go through the kernels at once; a longer text is alone.
SLICE_BYTES = 4_000_000
# Gains are whole thousandths.
UNIT = 1000


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield start, stop
        start = stop


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Each word's text number and dictionary index, and the dictionary's words in UTF-8."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=NO_WORD)
    owner, words = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(words.filter(full))
    found = coded.dictionary.cast(pa.binary()).to_pylist()
    return owner.filter(full).to_numpy(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), found


def feature_buckets(
    owner: np.ndarray, index: np.ndarray, words: list[bytes], size: int, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every run of ``size`` words within a text."""
    if size == 1:
        table = np.fromiter((crc32(word) % buckets for word in words), dtype=np.int64, count=len(words))
        return owner, table[index]
    count = max(0, len(index) - size + 1)
    whole = owner[:count] == owner[size - 1 :] if count else np.zeros(0, dtype=bool)
    runs = np.stack([index[step : step + count] for step in range(size)], axis=1)[whole]
    distinct, place = np.unique(runs, axis=0, return_inverse=True)
    table = np.fromiter(
        (crc32(b" ".join(words[n] for n in run)) % buckets for run in distinct), dtype=np.int64, count=len(distinct)
    )
    return owner[:count][whole], table[place.reshape(-1)]


def bucket_counts(
    df: DataFrame, text: str = "text", sizes: tuple[int, int] = (1, 1), buckets: int = BUCKETS
) -> DataFrame:
    """``bucket, n``: features of all texts per bucket, for buckets that have any.

    A task sends one row per bucket, however many texts it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0)
            for start, stop in _slices(texts):
                owner, index, words = words_of(texts.slice(start, stop - start))
                for size in range(sizes[0], sizes[1] + 1):
                    total += np.bincount(feature_buckets(owner, index, words, size, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = df.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(counts: DataFrame, target_counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Every bucket's gain, a whole number of thousandths. ``buckets`` numbers reach the driver."""

    def gathered(rows: DataFrame) -> np.ndarray:
        table = np.zeros(buckets)
        for row in rows.collect():
            table[row.bucket] = row.n
        return table

    s, t = gathered(counts), gathered(target_counts)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(UNIT * math.log(x)) for x in ratio], dtype=np.int64)


def weighed(
    df: DataFrame, gains: np.ndarray, text: str = "text", sizes: tuple[int, int] = (1, 1), carried: tuple[str, ...] = ("id",)
) -> DataFrame:
    """``carried`` columns with each text's ``n_words, n_features, weight``."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in carried), "n_words long, n_features long, weight long"])
    names = [*carried, "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carried))
            for start, stop in _slices(texts):
                rows = stop - start
                owner, index, words = words_of(texts.slice(start, rows))
                counts, weights = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
                for size in range(sizes[0], sizes[1] + 1):
                    texts_of, bucket = feature_buckets(owner, index, words, size, len(gains))
                    # Owners ascend, so a text's gains are one segment.
                    total = np.concatenate([[0], np.cumsum(gains.take(bucket))])
                    edges = np.searchsorted(texts_of, np.arange(rows + 1))
                    counts += np.diff(edges)
                    weights += np.diff(total[edges])
                found = [np.bincount(owner, minlength=rows), counts, weights]
                own = [batch.column(n).slice(start, rows) for n in range(len(carried))]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, found)], names)

    return df.select(*carried, F.col(text).cast("string")).mapInArrow(run, schema)


def _noise(id_column: str, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-UNIT * F.ln(-F.ln((h + 0.5) / float(1 << 32))))


def importance_report(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    sizes: tuple[int, int] = (1, 1),
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` per document; ``rank`` is null for what is not drawn.

    Of the documents with at least ``least_words`` words, ``percent`` of a
    hundred (rounded down) with the highest scores are drawn, ties to the
    smaller id; repeated rows of one id follow each other. Null and empty texts
    have no features and weight 0, a missing id draws the noise of an empty one
    and comes first among ties. Empty tables of documents or of target texts are
    counted as having no features. Other columns are ignored.
    """
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    gains = bucket_gains(
        bucket_counts(rows, "text", sizes, buckets), bucket_counts(target, target_text, sizes, buckets), buckets
    )
    scored = materialise(
        weighed(rows, gains, "text", sizes).withColumn("score", F.col("weight") + _noise("id", seed))
    )
    enough = F.col("n_words") >= least_words
    eligible = scored.where(enough).select("id", "n_features", "weight", "score")
    drawn = eligible.count() * percent // 100
    ranked = numbered_within(eligible.withColumn("one", F.lit(1)), "one", [F.desc("score"), "id", "n_features", "weight"])
    rank = F.when(F.col("nth") < drawn, F.col("nth") + 1)
    others = scored.where(~enough).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("nth"))
    told = ranked.select("id", "n_features", "weight", "score", "nth").unionByName(others)
    return told.select(F.col("id").alias(id_column), "n_features", "weight", "score", rank.cast("long").alias("rank"))


def resample(df: DataFrame, target: DataFrame, id_column: str = "doc_id", **settings) -> DataFrame:
    """The drawn rows of ``df``, every column as it is; settings as in ``importance_report``.

    Rows of one id are drawn together as soon as one of them is; rows without an
    id are never returned, since nothing tells them apart.
    """
    report = importance_report(df, target, id_column, **settings)
    drawn = materialise(report.where("rank is not null").select(id_column).distinct())
    return df.join(drawn, id_column, "left_semi").select(df.columns)
