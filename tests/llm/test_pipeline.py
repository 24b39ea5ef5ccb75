"""The pipeline's stages, each written and read again as the next one's documents."""

import corpus_pipeline
from affilspark.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "token_output"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "token_output":
            assert now.columns == columns
        if name == "near_dedup":
            assert now.count() == now.select("doc_id").distinct().count() < before
        docs = now
    assert docs.where("part = 0").count() > 0 and docs.select("slot").distinct().count() == docs.count()


def test_all_queries_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
