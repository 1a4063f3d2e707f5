import re
from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from tidemark.llm import pii, simhash
from tidemark.llm.common import DOCUMENT_COLUMNS
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    """The result of each stage, and before them the documents."""
    results, docs = [("documents", documents)], documents
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        results.append((name, docs))
    return dict(results)


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_but_the_last_return_documents(stages):
    for name, df in stages.items():
        if name != "packing":
            assert df.columns == DOCUMENT_COLUMNS


def test_language_keeps_clean_documents(stages):
    before, after = ids(stages["documents"]), ids(stages["language"])
    assert after <= before
    assert sum(after.values()) >= 0.98 * sum(before.values())


def test_one_of_each_group_stays(stages):
    classes = simhash.components(stages["language"]).collect()
    assert ids(stages["near_copies"]) == Counter({r["component_id"] for r in classes})


def test_personal_data_goes_and_documents_stay(stages):
    assert ids(stages["personal_data"]) == ids(stages["near_copies"])
    before = sum(len(pii.base_spans(r["text"] or "")) for r in stages["near_copies"].collect())
    after = sum(len(pii.base_spans(r["text"] or "")) for r in stages["personal_data"].collect())
    assert before > 0 == after


def test_mix_takes_words_of_its_input(stages):
    given = {r["doc_id"]: r["text"] for r in stages["personal_data"].collect()}
    total = Counter()
    for r in stages["mixing"].collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        total[r["doc_id"]] += len(words)
        assert set(words) <= set(given[r["doc_id"]].split())
    assert all(n <= 3 * len(given[d].split()) for d, n in total.items())


def test_packing_keeps_every_row(stages):
    assert ids(stages["packing"]).keys() == ids(stages["mixing"]).keys()


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = __spark_entry__.queries()["pipeline"](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["packing"].collect()))


def test_stages_take_messy_and_empty_tables(spark, sf_dir, messy, nothing):
    for docs in (messy, nothing):
        for _, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "test-stage")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
