"""Nearest vectors by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into balanced parts;
a softmax classifier learns which parts a vector's neighbours lie in. Every
vector is filed under its most probable part. A query is sent to its several
most probable parts, as many as held-out vectors of the sample need to meet
their neighbours, and compared there exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseledger.session import materialise

NEAREST = 5
QUERY_EVERY = 50
# Vectors the partitions are learned on; a tenth of them is held out.
SAMPLE = 8_192
# Vectors a part should have, and the largest number of parts the sample can teach.
PART_ROWS = 2_000
MAX_PARTS = 128
GRAPH_DEGREE = 10
# Share of held-out neighbours that have to lie in the parts searched.
RECALL = 0.95
# Vectors and queries compared in one task at once.
BLOCK_ROWS, BLOCK_QUERIES = 2_048, 2_048
SEED = 20250311


def _valid(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows by powers of two near their largest component: no rounding, squares stay in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _neighbours(queries: np.ndarray, points: np.ndarray, degree: int, own: bool) -> np.ndarray:
    """Places of each query's nearest points, itself left out if it is one of them (``own``)."""
    found = np.empty((len(queries), degree), dtype=np.int64)
    for start in range(0, len(queries), 512):
        near = queries[start : start + 512] @ points.T
        if own:
            near[np.arange(len(near)), np.arange(start, start + len(near))] = -2
        found[start : start + len(near)] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return found


def _balanced(liking: np.ndarray, rounds: int = 40) -> np.ndarray:
    """A label per row by liking, parts that draw too many rows growing dearer until all have their share."""
    rows, parts = liking.shape
    price, step = np.zeros(parts), 0.25 * (np.ptp(liking) + 1e-9)
    for _ in range(rounds):
        labels = np.argmax(liking - price, axis=1)
        price += step * (np.bincount(labels, minlength=parts) * parts / rows - 1).clip(-1, 1)
        step *= 0.93
    return np.argmax(liking - price, axis=1)


def partition_graph(vectors: np.ndarray, graph: np.ndarray, parts: int, draw: np.random.Generator) -> np.ndarray:
    """Balanced parts that cut few edges of the neighbour graph.

    Started from the closest of random centres; then every vector moves to where
    most of its neighbours, and of those it is a neighbour of, lie.
    """
    labels = _balanced(vectors @ vectors[draw.choice(len(vectors), parts, replace=False)].T)
    best, least = labels, np.inf
    for _ in range(25):
        cut = (labels[graph] != labels[:, None]).mean()
        if cut < least:
            best, least = labels, cut
        liking = np.zeros((len(vectors), parts))
        rows = np.repeat(np.arange(len(vectors)), graph.shape[1])
        np.add.at(liking, (rows, labels[graph.reshape(-1)]), 1.0)
        np.add.at(liking, (graph.reshape(-1), labels[rows]), 1.0)
        liking[np.arange(len(vectors)), labels] += 1.0
        labels = _balanced(liking + 1e-3 * draw.random(liking.shape))
    return best


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def train_router(vectors: np.ndarray, wanted: np.ndarray, rounds: int = 200, rate: float = 0.1) -> np.ndarray:
    """Softmax weights (last row: biases) that predict each vector's shares of parts."""
    inputs = np.hstack([vectors * np.sqrt(vectors.shape[1]), np.ones((len(vectors), 1))])
    weights = np.zeros((inputs.shape[1], wanted.shape[1]))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for n in range(1, rounds + 1):
        slope = inputs.T @ (_softmax(inputs @ weights) - wanted) / len(inputs) + 1e-4 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        weights -= rate * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-9)
    return weights


@dataclass(frozen=True)
class Router:
    """Which parts a vector's neighbours are likely in; ``probes`` of them are searched."""

    weights: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return self.weights.shape[1]

    def liking(self, unit: np.ndarray) -> np.ndarray:
        return unit @ (self.weights[:-1] * np.sqrt(unit.shape[1])) + self.weights[-1]


def fit_router(sample: np.ndarray, parts: int, recall: float = RECALL) -> Router:
    """Partition the sample's neighbour graph, learn it, and set the number of parts to search.

    A tenth of the sample takes no part in the fit. The vectors' neighbours lie
    further away in the sample than in the whole table, so the share of
    held-out neighbours met is a careful estimate.
    """
    draw = np.random.Generator(np.random.PCG64(SEED))
    unit = _unit(sample)[draw.permutation(len(sample))]
    held, known = np.split(unit, [len(unit) // 10])
    graph = _neighbours(known, known, min(GRAPH_DEGREE, len(known) - 1), True)
    labels = partition_graph(known, graph, parts, draw)
    wanted = np.zeros((len(known), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(known)), graph.shape[1]), labels[graph.reshape(-1)]), 1.0)
    wanted[np.arange(len(known)), labels] += 1.0
    router = Router(train_router(known, wanted / wanted.sum(axis=1, keepdims=True)), parts)
    # Biases such that the classifier's own parts are balanced as well.
    bias, own = router.weights[-1], router.liking(known)
    step = 1.0
    for _ in range(60):
        shares = np.bincount(np.argmax(own + bias - router.weights[-1], axis=1), minlength=parts) * parts / len(known)
        bias = bias - step * (shares - 1).clip(-1, 1) * 0.2
        step *= 0.95
    weights = np.vstack([router.weights[:-1], bias])
    router = Router(weights, parts)
    filed = np.argmax(router.liking(known), axis=1)
    near = filed[_neighbours(held, known, min(NEAREST, len(known)), False)]
    order = np.argsort(-router.liking(held), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    met = np.sort(np.take_along_axis(place, near, axis=1).reshape(-1))
    return Router(weights, int(met[min(len(met) - 1, int(np.ceil(recall * len(met))) - 1)]) + 1)


def _routed(vectors: DataFrame, routers: dict[int, Router], probes: bool, everywhere: bool = False) -> DataFrame:
    """The rows of ``vectors`` with ``part``: the most probable one, or one row for each to search.

    Parts of vectors of different lengths have different numbers; vectors of a
    length without a router share one part.
    """
    schema = ", ".join(f"{name} {kind}" for name, kind in vectors.dtypes) + ", part long"
    names = [*vectors.columns, "part"]
    place = vectors.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(place)).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(rows))
                base, router = int(size) * MAX_PARTS, routers.get(int(size))
                if router is None:
                    chosen = np.zeros((len(rows), 1), dtype=np.int64)
                else:
                    liking = router.liking(_unit(_matrix(part.column(place))))
                    width = (router.parts if everywhere else router.probes) if probes else 1
                    chosen = np.argsort(-liking, axis=1, kind="stable")[:, :width]
                repeated = part.take(pa.array(np.repeat(np.arange(len(rows)), chosen.shape[1])))
                yield pa.RecordBatch.from_arrays([*repeated.columns, pa.array(base + chosen.reshape(-1))], names)

    return vectors.mapInArrow(run, schema)


def _compared(queries: DataFrame, points: DataFrame, nearest: int) -> DataFrame:
    """``query, node, score, firsts``: the ``nearest`` points of every query in every cell.

    A cell is a block of a part's points and a block of its queries; a part of
    any size is dealt out over as many cells as it takes.
    """

    def blocks(rows: DataFrame, key: str, most: int, name: str) -> DataFrame:
        return rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / most).cast("long").alias(name))

    shape = materialise(
        blocks(points, "node", BLOCK_ROWS, "rows").join(blocks(queries, "query", BLOCK_QUERIES, "lots"), "part")
    )

    def dealt(rows: DataFrame, key: str, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        return (
            rows.join(shape, "part")
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(own_count)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_count) - 1)))
            .drop("rows", "lots")
        )

    cell = ["part", "block", "lot"]
    left = dealt(queries, "query", "lot", "lots", "block", "rows").groupBy(*cell)
    right = dealt(points, "node", "block", "rows", "lot", "lots").groupBy(*cell)

    def best(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query": [], "node": [], "score": [], "firsts": []})
        one, two = _scaled(np.array(asked["vector"].tolist())), _scaled(np.array(held["vector"].tolist()))
        norm_one, norm_two = np.sqrt((one * one).sum(axis=1)), np.sqrt((two * two).sum(axis=1))
        rough = (one / norm_one[:, None]) @ (two / norm_two[:, None]).T
        most = min(nearest, len(held))
        # All that the last bits of the product may have moved; decided by the exact measure below.
        low = np.array([ids[0] for ids in held["firsts"]])
        least = -np.partition(-rough, most - 1, axis=1)[:, most - 1] - 1e-9
        a, b = np.nonzero(rough >= least[:, None])
        nodes = held["node"].to_numpy()
        score = (one[a] * two[b]).sum(axis=1) / (norm_one[a] * norm_two[b])
        order = np.lexsort((low[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        kept = np.arange(len(a)) - np.searchsorted(a, a) < most
        a, b = a[kept], b[kept]
        return pd.DataFrame(
            {"query": asked["query"].to_numpy()[a], "node": nodes[b], "score": score[kept], "firsts": held["firsts"].to_numpy()[b]}
        )

    return left.cogroup(right).applyInPandas(best, "query long, node long, score double, firsts array<bigint>")


def nearest_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = QUERY_EVERY,
    nearest: int = NEAREST,
    recall: float = RECALL,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's nearest found, by cosine in double precision.

    Queries are the rows whose id ``every`` divides, candidates all others; all
    are given if there are fewer than ``nearest``, ties to the smaller id.
    Vectors that are null, empty, zero or hold nulls or non-finite numbers take
    no part, nor do rows without an id; vectors of different lengths are not
    compared. Rows of equal id and vector are one; rows of equal id and
    different vectors are asked and found one by one, never with each other.
    Equal vectors are compared once. Other columns are ignored.
    """
    double = F.transform(vector_column, lambda x: x.cast("double"))
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.when(_valid(double), double).alias("vector"))
    usable = materialise(rows.where("id is not null and vector is not null").groupBy("vector", "id").agg(F.lit(1).alias("one")))
    # No query needs more members of a class than its nearest and itself. The limit is applied
    # before the shuffle, so a class holding most rows costs each task a few.
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    leading = usable.select("vector", "id", first.alias("n")).where(F.col("n") <= nearest + 1)
    classes = materialise(
        leading.groupBy("vector")
        .agg(F.array_sort(F.collect_list("id")).alias("firsts"))
        .select(F.monotonically_increasing_id().alias("node"), "firsts", "vector")
    )
    asked = usable.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("vector").alias("of"))
    asked = materialise(
        asked.join(classes, F.col("of") == F.col("vector")).select("query_id", F.col("node").alias("query"), "vector")
    )
    routers = _fitted(classes, recall, part_rows)
    points = materialise(_routed(classes, routers, probes=False))
    queries = asked.select("query", "vector").dropDuplicates(["query"])

    def found(queries: DataFrame, everywhere: bool) -> DataFrame:
        routed = materialise(_routed(queries, routers, True, everywhere))
        met = _compared(routed, points, nearest + 1)
        closest = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("firsts")[0]))
        met = met.withColumn("n", closest).where(F.col("n") <= nearest + 1)
        ids = asked.select("query_id", "query").join(met, "query").select("query_id", "score", F.explode("firsts").alias("vec_id"))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        others = ids.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = others.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
        return materialise(ranked.select("query_id", "rank", "vec_id", "score"))

    told = found(queries, False)
    if routers:
        # Parts searched may hold fewer vectors than are asked for; then all are.
        full = told.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= nearest)
        short = materialise(asked.join(full, "query_id", "left_anti").select("query", "vector").dropDuplicates(["query"]))
        if not short.isEmpty():
            told = told.join(full, "query_id", "left_semi").unionByName(
                found(short, True).join(full, "query_id", "left_anti")
            )
    return told.select(
        F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("vec_id").cast("long"), "score"
    )


def _fitted(classes: DataFrame, recall: float, part_rows: int) -> dict[int, Router]:
    """A router for every vector length that has more than one part's worth of vectors."""
    sizes = classes.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    routers = {}
    for size, n in sorted(tuple(r) for r in sizes.where(F.col("n") > part_rows).collect()):
        chosen = classes.where(F.size("vector") == size).orderBy(F.xxhash64("vector"), F.col("firsts")[0]).limit(SAMPLE)
        sample = np.array([r.vector for r in chosen.select("vector").collect()])
        routers[size] = fit_router(sample, min(MAX_PARTS, -(-n // part_rows), max(2, len(sample) // 64)), recall)
    return routers
