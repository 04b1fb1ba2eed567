import importlib
import inspect

import pytest
from llm_tables import EDGE, FULL, edge, empty

import __spark_entry__
import corpus_pipeline
from despacho.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert names <= set(__spark_entry__.queries())
    assert set(queries.oracle_sql()) <= names


def test_stages_follow_each_other(spark):
    rows = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows.columns == ["doc_id", "ids", "n_tokens", "lossless"]
    got = rows.collect()
    assert 0 < len(got) < docs.count() and all(r.lossless for r in got)
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, SF)
        assert after.columns == docs.columns, name
        assert after.count() <= current.count()
        assert after.subtract(current).isEmpty()
        current = after
    assert {r.doc_id for r in got} == {r.doc_id for r in current.collect()}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_edge_rows_and_empty_tables(spark, name, stage):
    assert stage(spark, edge(spark), SF).count() <= len(EDGE)
    assert stage(spark, empty(spark), SF).collect() == []
    if name != "sentencepiece":
        assert stage(spark, edge(spark), SF).columns == [f.name for f in spark.createDataFrame([], FULL).schema]


def test_import_errors_are_not_swallowed():
    for module in (corpus_pipeline, importlib.import_module("despacho.llm.queries")):
        assert "except" not in inspect.getsource(module)
