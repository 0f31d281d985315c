import brute
import pytest

import corpus_pipeline
from pulseledger.llm import decontamination, quality, secret_scan


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's input and result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # A good text with a secret; its smaller id makes it the one that stays of its group.
    text = docs.where("doc_id = 6").first().text + f'\ntoken = "{"0123456789abcdef" * 3}"'
    docs = docs.unionByName(spark.createDataFrame([(-1, text, "en", "src1", len(text))], docs.schema))
    steps = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        stage(spark, docs, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
        steps.append((docs, result))
        docs = result
    return steps


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages, spark, sf_dir):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(result.columns == columns for _, result in stages[:-1])


def test_quality_keeps_what_the_classifier_accepts(stages, spark, sf_dir):
    docs, result = stages[0]
    rows = quality.quality_report(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert ids(result) == sorted(r.doc_id for r in rows if r.predicted)


def test_one_document_of_each_group_stays(stages):
    docs, result = stages[1]
    groups = brute.jaccard_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ids(result) == [doc for doc, _, component in groups if doc == component]


def test_leaks_go(stages, spark, sf_dir):
    docs, result = stages[2]
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {r.doc_id for r in decontamination.leak_report(docs, benchmark).collect()}
    assert ids(result) == [doc for doc in ids(docs) if doc not in found]


def test_secrets_go_and_documents_stay(stages):
    docs, result = stages[3]
    assert ids(docs) == ids(result)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert any(secret_scan.base_spans(text) for text in texts.values())
    for row in result.collect():
        assert not secret_scan.base_spans(row.text) and row.n_chars == len(row.text)
        if not secret_scan.base_spans(texts[row.doc_id]) and "[SECRET]" not in row.text:
            assert row.text == texts[row.doc_id]


def test_the_run_gives_every_kept_document_a_place(stages, spark, sf_dir):
    docs, result = stages[4]
    assert ids(docs) == ids(result)
    run = corpus_pipeline.run(spark, sf_dir).collect()
    # Without the planted text, whose group then keeps its first document.
    assert {r.doc_id for r in run} == set(ids(docs)) - {-1} | {6}


def test_awkward_rows(awkward, empty, spark, sf_dir):
    for frame in (awkward, empty):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert docs.count() <= frame.count()
