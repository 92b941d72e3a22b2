"""Registered queries against their SQL, and that the pipeline's stages keep to their form."""

from __future__ import annotations

import parity
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from oreflow.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql(spark, name):
    assert parity.compare(spark, parity.connect(FOLDER), FOLDER, name, queries.QUERIES[name], oracle.SQL[name]) > 0


def test_every_operator_is_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op")}
    assert "pipeline" in names


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    last = corpus_pipeline.STAGES[-1][0]
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), name)
        if name != last:
            assert docs.columns == columns
            assert 0 < docs.count() <= rows
            rows = docs.count()
            assert docs.where("n_chars <> length(text)").isEmpty()
    assert docs.select("doc_id").distinct().count() == rows
