import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from pulseledger.llm import importance_sampling


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def buckets(text, sizes, count):
    found = words(text)
    runs = (" ".join(found[n : n + size]) for size in range(sizes[0], sizes[1] + 1) for n in range(len(found) - size + 1))
    return [zlib.crc32(run.encode()) % count for run in runs]


def plain_report(docs, targets, sizes=(1, 1), count=10_000, percent=10):
    own, theirs = Counter(), Counter()
    for _, text in docs:
        own.update(buckets(text, sizes, count))
    for text in targets:
        theirs.update(buckets(text, sizes, count))
    s_all, t_all = sum(own.values()), sum(theirs.values())
    rows = []
    for doc, text in docs:
        found = buckets(text, sizes, count)
        gains = (
            math.floor(1000 * math.log(((theirs[b] + 1) * (s_all + count)) / ((own[b] + 1) * (t_all + count)))) for b in found
        )
        weight = sum(gains)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(words(text))])
    ranked = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for n, row in enumerate(ranked[: percent * len(ranked) // 100]):
        row[4] = n + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (2, 3)])
def test_equals_a_plain_count(spark, sf_dir, docs, sizes):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = importance_sampling.importance_report(docs, target, sizes=sizes, percent=25)
    assert sorted(map(tuple, found.collect()), key=str) == plain_report(
        [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], sizes, percent=25
    )


def test_awkward_rows(spark, awkward, empty):
    target = spark.createDataFrame([("very LONG",), (None,), ("",)], "text string")
    for targets in (target, target.limit(0)):
        found = importance_sampling.importance_report(awkward, targets, percent=100)
        expected = plain_report([(r.doc_id, r.text) for r in awkward.collect()], [r.text for r in targets.collect()], percent=100)
        assert sorted(map(tuple, found.collect()), key=str) == expected
    assert importance_sampling.importance_report(empty, target).collect() == []


def test_long_and_many_texts_cut_alike(spark, docs, monkeypatch):
    target = spark.createDataFrame([("the text",)], "text string")
    whole = sorted(map(tuple, importance_sampling.importance_report(docs, target).collect()), key=str)
    expected = plain_report([(r.doc_id, r.text) for r in docs.collect()], ["the text"])
    assert whole == expected
    import pyarrow as pa

    monkeypatch.setattr(importance_sampling, "SLICE_BYTES", 10)
    texts = pa.array(["aaaaaaaaaaaaaaaaaaaa", "b", "c", None, "dddddddddd", ""])
    cuts = list(importance_sampling._slices(texts))
    assert [n for a, b in cuts for n in range(a, b)] == list(range(6)) and cuts[0] == (0, 1)


def test_drawn_rows_come_back_whole(spark, docs):
    target = docs.where("lang = 'fr'").select("text")
    drawn = importance_sampling.resample(docs, target)
    report = importance_sampling.importance_report(docs, target)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in report.where("rank is not null").collect()}
    french = drawn.where("lang = 'fr'").count() / drawn.count()
    assert french > docs.where("lang = 'fr'").count() / docs.count()
