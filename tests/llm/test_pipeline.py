"""The pipeline against the brute-force stages, and on an empty table."""

import corpus_pipeline
import duckdb
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_pipeline_equals_brute_force_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    judged = corpus_pipeline.quality(spark, docs, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in judged.collect()]
    assert 0 < len(rows) < docs.count()
    rows = [(d, kept) for d, _, _, kept in brute.line_dedup(rows)]
    stay = {d for d, _, _, kept in brute.near_duplicates(rows) if kept}
    rows = [r for r in rows if r[0] in stay]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    dirty = {d for d, _, hit, _ in brute.contamination(rows, items) if hit}
    want = {d: brute.sha(t) for d, t in rows if d not in dirty}
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == want and len(got) == len(want)


def test_stages_keep_columns_and_pass_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0
