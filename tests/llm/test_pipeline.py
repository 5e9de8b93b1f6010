import importlib.util

import pytest
from pyspark.sql import functions as F

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("no pipeline here", allow_module_level=True)

import corpus_pipeline

from tests.llm.helpers import DOCS, odd_docs


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    for name in ("held_out", "predicted", "size", "target", "class_id", "kept_text", "n_removed"):  # names of results
        docs = docs.withColumn(name, F.lit(name))
    labels = spark.createDataFrame([(i, 1) for i in range(1, 18)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == docs.columns
        assert {(r.score, r.held_out, r.predicted, r["size"], r.class_id) for r in out.collect()} == {(0.1, "held_out", "predicted", "size", "class_id")}
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        assert out.count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_whole_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= set(docs)
