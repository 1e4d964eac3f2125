from __future__ import annotations

import pytest

import corpus_pipeline as pipeline
from mergelens.llm.oracles import ORACLES
from mergelens.llm.queries import QUERIES
from tests.compare import compare, connect
from tests.conftest import SF_SMALL, plan_text
from tests.llm import test_contamination, test_near_duplicates
from tests.llm.fixtures import documents, edited, odd_texts, prose
from tests.llm.test_secret_scan import naive


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    count, _, _ = compare(spark, connect(SF_SMALL), SF_SMALL, QUERIES[name], ORACLES[name])
    assert count > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_one_by_one(spark):
    """Each stage against brute force on what the stage before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    steps = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "secrets", "tokens",
    ]
    good = steps["quality"](spark, docs, SF_SMALL)
    assert good.columns == pipeline.COLUMNS and 0 < good.count() < docs.count()

    single = steps["near_duplicates"](spark, docs, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {k for k, _, _, keep in test_near_duplicates.brute_force(rows, 5, 80) if keep}
    assert set(by_id(single)) == kept and single.columns == pipeline.COLUMNS

    clean = steps["decontamination"](spark, docs, SF_SMALL)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    judged = test_contamination.brute_force(rows, items)
    assert set(by_id(clean)) == {j[0] for j in judged if not j[-1]}
    assert clean.columns == pipeline.COLUMNS

    safe = by_id(steps["secrets"](spark, docs, SF_SMALL))
    for key, text in rows:
        assert not naive(safe[key].text)
        assert safe[key].n_chars == len(safe[key].text)
        if "[SECRET]" not in safe[key].text:
            assert safe[key].text == text

    tokens = steps["tokens"](spark, docs, SF_SMALL)
    assert tokens.count() == docs.count()


def test_run_writes_every_stage(spark):
    got = pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert 0 < got.count() < 200


def test_stages_take_odd_and_empty_tables(spark):
    texts = odd_texts() + [edited(prose(90, 4), 60, 1)]
    ids = [None, None, *range(len(texts) - 2)]
    for df in (documents(spark, texts, ids, clashing=True), documents(spark, [])):
        for name, stage in pipeline.STAGES:
            out = stage(spark, df, SF_SMALL)
            assert out.count() <= df.count()
            assert name == "tokens" or out.columns == pipeline.COLUMNS
