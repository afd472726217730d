"""Stages of the pipeline on awkward tables, and the whole run against its parts."""

import corpus_pipeline
import pytest

from .common import awkward, table


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(0, 1, 0), (2, 1, 0), (10, 1, 0), (15, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, labelled, name, stage):
    docs = table(spark)
    got = stage(spark, docs, labelled)
    rows = got.collect()
    if name != "packing":
        assert got.columns == docs.columns and len(rows) <= len(awkward())
    empty = stage(spark, table(spark, []), labelled)
    assert empty.columns == got.columns and empty.count() == 0


def test_run(spark, sf):
    packed = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        docs = after.persist()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = [labels[i] for i in ids if i in labels]
    assert sum(kept) / len(kept) > 0.95
