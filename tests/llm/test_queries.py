"""Queries with a SQL twin against DuckDB, and what each query must return."""

import re

import pytest

import corpus_pipeline
from panelmint.checks.compare import difference, duck
from panelmint.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op3": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op4": {"doc_id", "n_shingles", "component_id", "kept"},
    "op5": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op8": {"vec_id", "n_links", "component_id", "kept"},
    "op9": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op10": {"doc_id", "held_out", "score", "predicted"},
    "op12": {"doc_id", "held_out", "lang_pred", "score"},
}


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), duck(FOLDER).sql(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in COLUMNS and n not in ORACLES))
def test_columns(spark, name):
    assert COLUMNS[name.split("_")[0]] <= set(QUERIES[name](spark, FOLDER).columns)


def test_stages_keep_columns_and_take_effect(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.land(stage(spark, left, FOLDER), "test-stage")
        assert set(after.columns) == set(docs.columns)
        if name != "mix":
            assert 0 < after.count() <= left.count()
        left = after
    got = corpus_pipeline.STAGES[-1][1](spark, left, FOLDER)
    assert got.where("piece = 0").count() == left.count()
