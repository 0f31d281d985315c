import numpy as np
import pytest

from pulseledger.llm import vector_search


def exact(rows, every, nearest):
    """Every query against every row."""
    found = {}
    for q, vector in rows:
        if q % every:
            continue
        scored = []
        for other, with_ in rows:
            if other != q:
                a, b = np.array(vector), np.array(with_)
                scored.append((-(a @ b) / np.sqrt((a @ a) * (b @ b)), other))
        found[q] = [(other, -score) for score, other in sorted(scored)[:nearest]]
    return found


def told(df):
    result = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        result.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return result


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(11)
    centres = draw.standard_normal((40, 16))
    rows = [(n, (centres[draw.integers(0, 40)] + 0.5 * draw.standard_normal(16)).tolist()) for n in range(1500)]
    # A third of all rows is one vector.
    return rows + [(1500 + n, rows[0][1]) for n in range(750)]


def test_recall_over_learned_parts(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = told(vector_search.nearest_vectors(df, every=10, part_rows=150))
    expected = exact(vectors, 10, 5)
    assert set(found) == set(expected)
    hits = 0
    for query, rows in found.items():
        assert [rank for rank, *_ in rows] == [1, 2, 3, 4, 5]
        scores = {other: score for other, score in expected[query]}
        if vectors[query][1] == vectors[0][1]:
            # Ties among equal vectors go to the smaller ids.
            assert [other for _, other, _ in rows] == [n for n in [0, *range(1500, 1507)] if n != query][:5]
        hits += sum(other in scores for _, other, _ in rows)
        assert all(abs(score - scores[other]) < 1e-12 for _, other, score in rows if other in scores)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(rows, rows[1:]))
    assert hits >= 0.9 * 5 * len(expected)


def test_fewer_parts_are_searched_where_vectors_cluster(vectors):
    distinct = np.array([v for _, v in vectors[:1500]])
    router = vector_search.fit_router(distinct, 8)
    filed = np.bincount(np.argmax(router.liking(vector_search._unit(distinct)), axis=1), minlength=8)
    assert router.probes <= 5 and filed.min() > 0 and filed.max() < 3 * 1500 / 8


def test_parts_with_too_few_vectors_are_made_up_for(spark, vectors, monkeypatch):
    few = vector_search.Router(np.zeros((17, 4)), 1)
    monkeypatch.setattr(vector_search, "fit_router", lambda *a: few)
    sides = vector_search.Router(np.vstack([np.eye(16, 4) * 50, np.zeros(4)]), 1)
    rows = vectors[:60]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for router in (few, sides):
        monkeypatch.setattr(vector_search, "fit_router", lambda *a, router=router: router)
        found = told(vector_search.nearest_vectors(df, every=7, nearest=40, part_rows=10))
        assert all(len(rows) == 40 for rows in found.values()) and len(found) == 9
        expected = exact(rows, 7, 40)
        assert all([other for _, other, _ in found[q]] == [other for other, _ in expected[q]] for q in found)


def test_small_table_is_exact_and_awkward_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (100, [0.0, 3.0]), (3, None), (4, []),
        (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [inf, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]),
        (150, [1.0, 1.0, 1.0]), (200, None), (10, [-1e-30, 0.0]), (11, [2.0**600, 2.0**600]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'clash' AS node", "1 AS part", "'x' AS query", "2 AS rank", "3 AS score"
    )
    found = told(vector_search.nearest_vectors(df))
    half = np.sqrt(0.5)
    assert {q: [(r, v) for r, v, _ in rows] for q, rows in found.items()} == {
        50: [(1, 1), (2, 2), (3, 11), (4, 100), (5, 10)],
        100: [(1, 2), (2, 11), (3, 1), (4, 10), (5, 50)],
        150: [(1, 9)],
    }
    assert np.allclose([s for *_, s in found[50]], [1, half, half, 0, -1])
    assert told(vector_search.nearest_vectors(df.limit(0))) == {}
    assert vector_search.nearest_vectors(df).dtypes == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")
    ]
