import brute
import numpy as np
import pytest

from pulseledger.llm import embedding_dedup


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((150, 64))
    rows = []
    for n in range(900):
        centre = centres[draw.integers(0, 150)]
        rows.append((n, (centre + draw.standard_normal(64) * draw.choice([0.01, 0.15, 0.4])).astype("float32").tolist()))
    rows += [(900 + n, rows[n][1]) for n in range(20)]
    return rows


def test_links_and_components_equal_brute_force(spark, vectors):
    unit = np.array([v for _, v in vectors], dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    groups = brute.Groups(range(len(vectors)))
    for a, b in zip(*np.nonzero(near)):
        groups.join(int(a), int(b))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    links = np.array([found[n].n_links for n in range(len(vectors))])
    expected = near.sum(1) - 1
    assert (links <= expected).all() and links.sum() >= 0.99 * expected.sum()
    right = [found[n].component_id == groups.find(n) for n in range(len(vectors))]
    assert np.mean(right) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, []), (6, [inf, 1.0]),
        (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]),
        (11, [1e-30, 2e-30]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'clash' AS node", "1 AS id")
    found = [(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()]
    assert sorted(found, key=str) == sorted(
        [(n, 0, n) for n in (1, 2, 3, 4, 5, 6, 10, None)] + [(n, 3, 7) for n in (7, 8, 9, 9, 11)], key=str
    )
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []
