"""The registered queries against their SQL and the pipeline stage by stage."""

import os
import re

import pytest

import __spark_entry__ as entry
import brute
import corpus_pipeline
from check import connect, differences
from runscope.llm import oracle, queries, sentence_pieces as sp

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.registered()) == list(range(1, 14))
    assert "pipeline" in names and set(oracle.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    problems, _ = differences(spark, connect(sf), name, sf)
    assert problems == []


def test_nothing_else_imports_the_package():
    for top, _, files in os.walk(os.path.join(ROOT, "runscope")):
        for name in files:
            if name.endswith(".py") and "llm" not in top.split(os.sep):
                assert "llm" not in open(os.path.join(top, name)).read(), name


def test_stages(spark, sf):
    docs = before = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = results[name] = corpus_pipeline.written_table(stage(spark, docs, sf), name)
        if name != "sentence_pieces":
            assert docs.columns == before.columns
    texts = {n: {r["doc_id"]: r["text"] for r in d.collect()} for n, d in results.items() if n != "sentence_pieces"}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    all_ids = {r["doc_id"] for r in before.collect()}
    assert len(good & set(texts["quality_classifier"])) >= 0.95 * len(good & all_ids)
    # What stays of a text is some of its lines, in their order.
    for i, t in texts["line_dedup"].items():
        lines = iter(texts["quality_classifier"][i].split("\n"))
        assert all(x in lines for x in t.split("\n"))
    want = brute.near_duplicates(texts["line_dedup"], corpus_pipeline.NEAR_PERCENT)
    assert set(texts["near_dedup"]) == {i for i, (_, _, kept) in want.items() if kept}
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    hits = brute.contamination(texts["near_dedup"], items)
    assert set(texts["decontamination"]) == {i for i, h in hits.items() if not h[4]}
    shared = sp.vocabulary(spark)
    back = {r["doc_id"]: r["text"] for r in sp.decode(results["sentence_pieces"], shared).collect()}
    assert back == texts["decontamination"]
