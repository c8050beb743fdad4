"""The registered corpus queries and the pipeline on the smallest driver tables."""

from pathlib import Path

import pytest
from corpus_cases import components, removed_spans

import corpus_pipeline
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows
    if "doc_id" in rows[0]:
        assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}


def test_near_duplicate_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    wanted, _ = components(texts, 85)
    assert {r.doc_id: r.component_id for r in QUERIES["op7_near_duplicates"](spark, SF).collect()} == wanted


def test_suffix_query(spark):
    masks = removed_spans({r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})
    assert {r.doc_id: r.n_removed for r in QUERIES["op3_suffix_dedup"](spark, SF).collect()} == {i: sum(m) for i, m in masks.items()}


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        found = after.collect()
        assert 0.75 * before < len(found) <= before, name
        if name == "near_duplicates":
            texts = {r.doc_id: r.text for r in docs.collect()}
            wanted, _ = components(texts, 80)
            assert {r.doc_id for r in found} == {i for i, c in wanted.items() if i == c}
        if name == "suffix_dedup":
            texts = {r.doc_id: r.text for r in docs.collect()}
            masks = removed_spans(texts)
            left = {i: bytes(b for b, m in zip(t.encode(), masks[i]) if not m).decode("utf-8", "ignore") for i, t in texts.items()}
            assert {r.doc_id: r.text for r in found} == left
        docs, before = spark.createDataFrame(found, after.schema), len(found)
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(texts)
    assert packed.filter("size(ids) <> length OR offset + length > 2048").count() == 0
