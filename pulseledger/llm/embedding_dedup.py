"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine, components.

Each table hashes a vector to the signs of its products with random
hyperplanes. Vectors that share a table's signs are candidates; a longer sign
sketch drops pairs that are far apart, and what is left is checked exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import connected_components, mixed, signed
from pulseledger.session import materialise

COSINE = 0.9
SEED = 20240607
# Chance that a pair exactly at the threshold meets in no table.
MISS = 0.005
SKETCH_BITS = 256
# Sketch bits a pair at the threshold may differ in: the mean and six standard deviations.
SKETCH_SPARE = 6.0


def plan_tables(vectors: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Signs per table and number of tables for so many vectors.

    The signs grow with the logarithm of the number of vectors, so buckets of
    unrelated vectors keep their size; the tables follow from the miss rate.
    """
    bits = max(6, min(30, math.ceil(math.log2(max(vectors, 2))) - 2))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def _valid(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _dot(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _signed_tables(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """``node, size, keys, s0 ... s3``: a vector's bucket in every table and its sketch."""
    schema = "node long, keys array<bigint>, s0 long, s1 long, s2 long, s3 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            vectors = batch.column("unit").to_pylist()
            for width in sorted({len(v) for v in vectors}):
                rows = [n for n, v in enumerate(vectors) if len(v) == width]
                if width not in planes:
                    draw = np.random.Generator(np.random.PCG64([SEED, width]))
                    planes[width] = draw.standard_normal((width, tables * bits + SKETCH_BITS))
                signs = np.array([vectors[n] for n in rows]) @ planes[width] > 0
                buckets = signs[:, : tables * bits].reshape(len(rows), tables, bits) @ weights
                salted = mixed(buckets.astype(np.uint64) ^ mixed(np.arange(1, tables + 1, dtype=np.uint64) + np.uint64(width << 20)))
                sketch = np.packbits(signs[:, tables * bits :], axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[rows]), pa.array(list(signed(salted)), pa.list_(pa.int64())), *map(pa.array, sketch.T.copy())],
                    ["node", "keys", "s0", "s1", "s2", "s3"],
                )

    return classes.select("node", "unit").mapInArrow(run, schema)


def near_duplicates(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """``id, n_links, component_id, kept`` per input row.

    Links join vectors found with cosine of at least ``cosine`` in double
    precision, none below it. Vectors that are null, empty, zero or hold nulls
    or non-finite numbers link with nothing, nor do vectors of different
    lengths. Equal vectors are one class: all its members are linked. Rows of
    equal id and vector are one vector, rows of equal id and different vectors one
    node with the links of all; rows without an id link with nothing and have a
    null component. An empty table gives an empty one. ``n_links`` needs
    every linked pair of different vectors once, so a group of near copies costs
    the square of its number of different vectors; joins of hot buckets are
    between two stored tables, which Spark can split.
    """
    ids = F.col(id_column).cast("long")
    double = F.transform(vector_column, lambda x: x.cast("double"))
    rows = materialise(df.select(ids.alias("id"), F.when(_valid(double), double).alias("vector")))
    usable = rows.where("id is not null and vector is not null").groupBy("vector", "id").agg(F.lit(1).alias("one"))
    norm = F.sqrt(F.aggregate(F.transform("vector", lambda x: x * x), F.lit(0.0), lambda total, x: total + x))
    classes = materialise(
        usable.groupBy("vector")
        .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("size"))
        .withColumn("largest", F.array_max(F.transform("vector", F.abs)))
        # Scaled first, so that squares neither overflow nor vanish.
        .withColumn("vector", F.transform("vector", lambda x: x / F.col("largest")))
        .withColumn("unit", F.transform("vector", lambda x: x / norm))
        .select("node", "size", "unit")
    )
    bits, tables = plan_tables(classes.count(), cosine)
    signs = materialise(_signed_tables(classes, bits, tables))
    sketch = ["s0", "s1", "s2", "s3"]
    buckets = materialise(signs.select(F.explode("keys").alias("key"), "node", *sketch))
    share = math.acos(cosine) / math.pi
    most = SKETCH_BITS * share + SKETCH_SPARE * math.sqrt(SKETCH_BITS * share * (1 - share))
    left = buckets.select("key", F.col("node").alias("a"), *(F.col(s).alias(f"a{s}") for s in sketch))
    right = buckets.select("key", F.col("node").alias("b"), *(F.col(s).alias(f"b{s}") for s in sketch))
    apart = sum((F.bit_count(F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))) for s in sketch), F.lit(0))
    candidates = left.join(right, "key").where((F.col("a") < F.col("b")) & (apart <= most)).select("a", "b").distinct()
    one = classes.select(F.col("node").alias("a"), F.col("unit").alias("ua"), F.col("size").alias("na"))
    two = classes.select(F.col("node").alias("b"), F.col("unit").alias("ub"), F.col("size").alias("nb"))
    links = materialise(
        materialise(candidates).join(one, "a").join(two, "b").where(_dot("ua", "ub") >= cosine).select("a", "b", "na", "nb")
    )
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.col("nb").alias("n")), F.struct(F.col("b").alias("node"), F.col("na").alias("n"))
    )
    counts = links.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.n").alias("other"))
    parts = connected_components(links.select("a", "b"))
    told = materialise(
        classes.groupBy("node").agg(F.sum("size").alias("size"))
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .select(
            "node",
            (F.col("size") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "node").alias("component_id"),
        )
    )
    members = materialise(
        usable.join(usable.groupBy("vector").agg(F.min("id").alias("node")), "vector").select("id", "vector", "node")
    )
    found = (
        rows.join(members, ["id", "vector"], "left")
        .join(told, "node", "left")
        .select(
            F.col("id").cast(dict(df.dtypes)[id_column]).alias(id_column),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    return found.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))
