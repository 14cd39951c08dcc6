"""The pipeline's stages follow each other and keep their promises."""

import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_stages(spark):
    import corpus_pipeline as p
    from speechlake.llm import decontaminate
    from speechlake.operators.checkpoints import settle

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in p.STAGES:
        docs = settle(stage(spark, docs, SMALL))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left, name
        ids = left
        if name != "mix":
            assert docs.columns == columns
        if name == "benchmark":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert decontaminate.document_hits(docs, bench).where("n_hit > 0").count() == 0
    assert docs.where("taken <= 0 or taken > 3 * size").count() == 0


def test_stages_take_odd_rows(spark):
    import corpus_pipeline as p

    odd = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, "a", 0), (3, "x y", None, None, 3), (3, "x y", None, None, 3)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for name, stage in p.STAGES:
            assert stage(spark, docs, SMALL).count() >= 0, name
