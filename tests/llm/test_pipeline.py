"""The pipeline's stages on a small folder of tables, each judged on what the stage before kept."""

import pytest

import corpus_pipeline
from daybook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    return out


def test_stages_keep_the_columns_and_take_effect(kept):
    columns = kept["documents"].columns
    for name in ("quality_rules", "jaccard_join", "substring_dedup", "mixing"):
        assert kept[name].columns == columns
    n = {name: df.count() for name, df in kept.items()}
    assert n["documents"] > n["quality_rules"] >= n["jaccard_join"] == n["substring_dedup"] > 0
    assert n["mixing"] == n["bpe"]


def test_no_near_copies_are_left_and_each_had_one(spark, kept):
    from daybook.llm import jaccard_join

    of = jaccard_join.classes(kept["quality_rules"].selectExpr("doc_id AS id", "text")).collect()
    assert {r["component"] for r in of} == {r["doc_id"] for r in kept["jaccard_join"].collect()}


def test_registered_once_each():
    assert [int(q[2:].split("_")[0]) for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]) if q != "pipeline" else 99) if q != "pipeline"] == list(range(1, 14))
    assert "pipeline" in QUERIES
