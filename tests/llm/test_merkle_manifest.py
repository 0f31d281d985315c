import hashlib
import zlib
from collections import defaultdict

import pytest

from pulseledger.llm import merkle_manifest


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, add=0):
    values = (row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + add, row.text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """The root and each leaf's siblings (is it to the left, digest or none), level by level."""
    paths, row, level = [[] for _ in digests], list(digests), 0
    while len(row) > 1:
        for n, path in enumerate(paths):
            beside = (n >> level) ^ 1
            path.append(((n >> level) & 1, row[beside] if beside < len(row) else ""))
        row = [H("".join(row[n : n + 2])) for n in range(0, len(row), 2)]
        level += 1
    return row[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    below = {lang: tree([leaf(r) for r in groups[lang]]) for lang in langs}
    root, above = tree([below[lang][0] for lang in langs])
    found = []
    for n, lang in enumerate(langs):
        for row, path in zip(groups[lang], below[lang][1]):
            path = path + above[n]
            touched = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
            folded = leaf(row, 1 if touched else 0)
            for left, digest in path:
                folded = H(digest + folded if left else folded + digest)
            proof = H("".join(digest for _, digest in path))
            found.append((row.doc_id, leaf(row), below[lang][0], root, proof, folded, folded == root))
    return sorted(found, key=str)


@pytest.mark.parametrize("stride", [1, 3, 8])
def test_equals_a_plain_tree(spark, docs, stride):
    found = sorted(map(tuple, merkle_manifest.manifest(docs, stride=stride).collect()), key=str)
    assert found == plain_manifest(docs.collect())
    assert {r[-1] for r in found} == {True, False}


def test_awkward_rows(spark, awkward, empty):
    found = sorted(map(tuple, merkle_manifest.manifest(awkward, stride=2).collect()), key=str)
    assert found == plain_manifest(awkward.collect())
    assert merkle_manifest.manifest(empty).collect() == []


def test_single_row_has_an_empty_proof(spark):
    df = spark.createDataFrame([(3, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle_manifest.manifest(df).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == H("") and row.verified


def test_only_tampered_rows_with_a_count_fail(spark):
    rows = [(n, "t", None if n % 2 else "en", None, n if n % 3 else None) for n in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for row in merkle_manifest.manifest(df).collect():
        assert row.verified == (zlib.crc32(str(row.doc_id).encode()) % 7 != 0 or row.doc_id % 3 == 0)


def test_row_limit_of_recursive_queries_is_put_back(spark, docs):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle_manifest.manifest(docs.limit(3))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
