"""The pipeline stage by stage on a small table."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_keep_columns_and_drop_what_they_must(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs.count()]
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, sf_dir).persist()
        assert current.columns == docs.columns, name
        seen.append(current.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    last = corpus_pipeline.STAGES[-1][1](spark, current, sf_dir)
    assert last.filter(~F.col("round_trip")).count() == 0 and last.count() == seen[-1]


def test_stages_stand_odd_rows_and_other_columns(spark, sf_dir):
    schema = "doc_id long, text string, lang string, n_chars int, score double, _row string, item_id long"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", 0, 0.5, "r", 1), (1, "", "en", 0, 0.5, "r", 1),
            (2, "Write to me at me@example.com or +1 (212) 555-0100 please.", "en", 58, 0.1, "r", 2)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.schema.simpleString() == f"struct<{schema.replace(' long', ':bigint').replace(' string', ':string').replace(' int', ':int').replace(' double', ':double').replace(', ', ',')}>"
        out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert all(r["round_trip"] for r in out)


def test_run_is_the_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).filter(~F.col("round_trip")).count() == 0
