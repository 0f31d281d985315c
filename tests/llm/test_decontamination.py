import random

import pytest

from pulseledger.llm import decontamination


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def test_planted_passages_are_found_and_clean_texts_left(spark, docs, benchmark):
    draw = random.Random(1)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    clean = [r.text for r in docs.collect()]
    planted, expected = [], set()
    for n, (item, text) in enumerate(items):
        words = text.split()
        if len(words) > 40:
            words[draw.randrange(5)] = "changed"
        passage = " ".join(words) if n % 2 else text.upper().replace(".", " ;")
        planted.append((10_000 + n, f"{draw.choice(clean)[:200]}\n{passage}\n{draw.choice(clean)[:200]}"))
        expected.add((10_000 + n, item))
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id): r.similarity for r in decontamination.leak_report(frame, benchmark).collect()}
    assert expected <= set(found) and min(found.values()) >= 0.75
    texts = {r.doc_id: " ".join(r.text.split()) for r in frame.collect()}
    bodies = {item: " ".join(text.split()) for item, text in items}
    verbatim = {(d, i) for d, t in texts.items() for i, body in bodies.items() if body in t}
    assert verbatim <= set(found)
    for doc, item in set(found) - verbatim - expected:
        assert len(decontamination._similarity.__doc__) and doc < 20_000
    kept = {r.doc_id for r in decontamination.remove_leaks(frame, benchmark).collect()}
    assert kept == set(texts) - {doc for doc, _ in found}


def test_awkward_rows(spark, awkward, empty, benchmark):
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (None, "one two three"), (3, "two words"), (3, "two words")], "item_id long, text string"
    )
    found = decontamination.leak_report(awkward, odd).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in found] == [(7, 3, 1.0)]
    assert decontamination.remove_leaks(awkward, odd).count() == awkward.count() - 1
    assert decontamination.leak_report(empty, benchmark).collect() == []
    assert decontamination.leak_report(awkward, benchmark.limit(0)).collect() == []
    assert decontamination.remove_leaks(awkward, benchmark).schema == awkward.schema
