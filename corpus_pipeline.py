"""From raw documents to an ordered training mix, one operator per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseledger.llm import decontamination, jaccard_join, mixing, quality, secret_scan
from pulseledger.session import delete_folders, materialise, scratch


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; null and empty texts are scored as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Documents without words or without an id are kept; rows of one id stay or go
    together.
    """
    groups = jaccard_join.jaccard_components(docs)
    spare = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(materialise(spare), "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontamination.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` counted anew where a text changed."""
    before = F.col("n_chars")
    redacted = secret_scan.redact(docs)
    return redacted.withColumn(
        "n_chars", F.when(F.col("text").isNull(), before).otherwise(F.length("text").cast("long"))
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in the mix; sources weighted by the square root of their documents."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good_texts),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

# SQL can't express the trained classifier or the zstandard measure; tests/llm compare the
# stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next.

    What a stage stores on its way goes when its result is stored, and that when
    the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    *first, (_, last) = STAGES
    for _, stage in first:
        with scratch(spark) as stored:
            docs = materialise(stage(spark, docs, sf_dir))
            result = stored.pop()
        delete_folders(spark, before)
        before = [result]
    return last(spark, docs, sf_dir)
