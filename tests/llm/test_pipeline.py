"""The pipeline: its stages by themselves, and run() as a whole."""

import os

import pytest

from tests.llm import brute
from tools.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "mixing", "bpe"]
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        frames.append(docs)
    told, lined, single, mixed, encoded = frames
    source = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(f.columns == source.columns for f in frames[:-1])
    rows = [tuple(r) for r in lined.select("doc_id", "text").collect()]
    components = brute.near_components(rows, 5)
    assert {r["doc_id"] for r in single.collect()} == {d for d, (_, c) in components.items() if c == d}
    assert mixed.count() == encoded.count() == corpus_pipeline.run(spark, SF).count()
    gone = {r["doc_id"]: r["text"] for r in source.collect()}
    dropped = brute.repeated_lines([(r["doc_id"], r["text"]) for r in told.collect() if len(r["text"] or "") < 2000], 20, 0)
    kept = dict(rows)
    for d in list(dropped)[:50]:
        assert kept.get(d) != gone[d]


@pytest.mark.parametrize("name", ("op1_mix",))
def test_query_against_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries
    problem, rows, _ = compare(spark, connect(SF), queries()[name], oracle_sql()[name], SF)
    assert not problem and rows > 0
