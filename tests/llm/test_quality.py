import zlib

import numpy as np
import pytest

from pulseledger.llm import quality


@pytest.fixture(scope="module")
def larger(spark, sf_dir):
    folder = sf_dir.rsplit("/", 1)[0] + "/sf0.01"
    return tuple(spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))


def test_held_out_accuracy(larger):
    docs, labels = larger
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.quality_report(docs, labels).collect()]
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([p == t for p, t in held]) > 0.93


def test_labels_do_not_leak_from_the_held_out_fifth(larger):
    docs, labels = larger
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality")
    score = lambda model: sorted(quality.score(docs, model).collect())
    assert score(quality.fit(docs, labels)) == score(quality.fit(docs, flipped))


def test_pairs_learn_an_interaction():
    draw = np.random.default_rng(0)
    values = np.zeros((4000, len(quality.FEATURES)))
    values[:, :2] = draw.uniform(-1, 1, (4000, 2))
    labels = (values[:, 0] * values[:, 1] > 0).astype(float)
    model = quality.fit_tables(values[:3000], labels[:3000])
    assert np.mean((model.score(values[3000:]) > 0.5) == labels[3000:]) > 0.85


def test_awkward_rows(spark, awkward, empty, larger):
    docs, labels = larger
    model = quality.fit(docs, labels)
    scores = {r.doc_id: r.score for r in quality.score(awkward, model).collect()}
    assert scores[1] == scores[2] and quality.score(awkward, model).count() == awkward.count()
    kept = quality.keep_good(awkward, model)
    assert kept.schema == awkward.schema
    assert kept.count() == sum(r.score >= 0.3 for r in quality.score(awkward, model).collect())
    assert quality.score(empty, model).collect() == [] and quality.keep_good(empty, model).collect() == []
    unlabelled = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(awkward, unlabelled).collect()} == {0.5}
