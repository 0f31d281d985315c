import random

import brute
import numpy as np

from pulseledger.llm import jaccard_join


def edited(texts, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(120):
        words = draw.choice(texts).split()[: draw.choice([3, 6, 12, 40, 80, 200])]
        for _ in range(draw.randint(1, 3)):
            copy = list(words)
            for _ in range(draw.randint(0, max(1, len(copy) // 25))):
                copy[draw.randrange(len(copy))] = f"edit{draw.randrange(5)}"
            rows.append((1_000_000 + len(rows), " ".join(copy)))
    return rows


def test_components_equal_brute_force(spark, docs):
    base = docs.select("doc_id", "text")
    more = spark.createDataFrame(edited([r.text for r in base.collect()], 3), base.schema)
    rows = base.unionByName(more)
    found = jaccard_join.jaccard_components(rows).collect()
    expected = brute.jaccard_components([tuple(r) for r in rows.collect()])
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected
    assert any(doc != component for doc, _, component in expected)


def test_awkward_rows(awkward, empty):
    found = jaccard_join.jaccard_components(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[7] == (1, 7)
    assert by_id[5] == by_id[6] == (2, 5) and by_id[3] == by_id[4] and by_id[4][1] == 3
    assert by_id[None][1] is None
    assert jaccard_join.jaccard_components(empty).collect() == []


def test_sets_with_too_few_segments_are_named_and_found_with_another_salt():
    draw = np.random.default_rng(1)
    sets = [draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 4, 6, 7, 20, 63, 64, 65, 100, 400)]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    left = set(range(len(sets)))
    for salt in range(40):
        _, _, lacking = jaccard_join.signatures(owner, np.concatenate(sets), sizes, np.empty(0, np.uint64), salt)
        left &= set(lacking.tolist())
    assert not left


def test_pairs_within_reach_share_a_signature():
    draw = np.random.default_rng(2)
    for size in (3, 5, 8, 20, 48, 50, 64, 66, 90, 130, 300):
        for _ in range(20):
            one = draw.integers(0, 1 << 63, size).astype(np.uint64)
            change = int(draw.integers(0, size // 7 + 1))
            two = np.concatenate([one[change:], draw.integers(0, 1 << 63, change).astype(np.uint64)])
            both = len(np.intersect1d(one, two))
            if 100 * both < 75 * (2 * size - both):
                continue
            owner, sizes = np.repeat([0, 1], size), np.array([size, size])
            of, found, lacking = jaccard_join.signatures(owner, np.concatenate([one, two]), sizes, np.empty(0, np.uint64), 0)
            assert len(lacking) == 2 or set(found[of == 0]) & set(found[of == 1])
