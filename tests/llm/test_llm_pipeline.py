"""The pipeline stage by stage, and the registered queries against their SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import shrink_heaps, staged
from tidemark.llm.langid import language_id
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES
from tidemark.shared import child_names, shared_folder

from test_llm_decontaminate import brute as contamination
from test_llm_jaccard import brute as groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_keeps_what_it_should(spark, sf_dir):
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard", "decontaminate", "mixing", "tokens"]
    inputs, docs = [], first
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = staged(spark, stage(spark, docs, sf_dir), f"test-{name}")
        if name != "tokens":
            assert docs.columns == COLUMNS
    kept = {name: [r.doc_id for r in frame.collect()] for name, frame in zip(names, [*inputs[1:], docs], strict=True)}

    judged = language_id(first).where("not rejected").select("doc.doc_id").collect()
    assert sorted(kept["language_id"]) == sorted(r.doc_id for r in judged)
    rows = [(r.doc_id, r.text) for r in inputs[1].collect()]
    assert sorted(kept["jaccard"]) == sorted(key for key, n, c in groups(rows, 5, 80) if key == c or not n)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r.doc_id for r in inputs[2].collect() if not contamination(r.text, items)[3]]
    assert sorted(kept["decontaminate"]) == sorted(clean)
    assert sorted(set(kept["mixing"])) == sorted(set(kept["tokens"])) and len(kept["mixing"]) == len(kept["tokens"])
    assert set(kept["mixing"]) <= set(clean)


def test_stages_take_any_rows(spark, tricky, nothing, documents, sf_dir):
    """Nulls in any column, repeated rows, long texts and empty tables pass through all stages."""
    plain = documents([(n, f"some words of text {n} and more of them", "en", "s1") for n in range(40)])
    for docs in (tricky, nothing, tricky.unionByName(plain)):
        rows, columns = docs.count(), docs.columns
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            docs = staged(spark, stage(spark, docs, sf_dir), f"test-{name}")
            if name == "tokens":
                assert docs.count() == before.count()
            else:
                assert docs.columns == columns
                kept = docs.select("doc_id", "text").distinct()
                assert kept.exceptAll(before.select("doc_id", "text").distinct()).isEmpty()
                assert docs.count() <= rows * (2 if name == "mixing" else 1)


def test_stages_leave_nothing_behind(spark, sf_dir):
    folder = f"{shared_folder(spark)}/tidemark"
    before = set(child_names(spark, folder))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = corpus_pipeline.run(spark, sf_dir)
    left = {name.rsplit("-", 1)[0] for name in set(child_names(spark, folder)) - before}
    # The store itself and what was read back from it stay.
    assert left == {"tokens", "pipeline-tokens"}
    assert docs.count() > 0 and result.count() > 0


def collections(spark):
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(bean.getCollectionCount() for bean in beans if "Old" in bean.getName() or "MarkSweep" in bean.getName())


def test_heaps_are_collected(spark):
    before = collections(spark)
    shrink_heaps(spark)
    assert collections(spark) > before


def test_stages_begin_with_shrunk_heaps(spark, nothing, sf_dir, monkeypatch):
    order = []
    monkeypatch.setattr(corpus_pipeline, "shrink_heaps", lambda spark: order.append("shrink"))
    stage = corpus_pipeline._tidy(lambda spark, docs, sf_dir: order.append("stage") or docs)
    assert stage(spark, nothing, sf_dir) is nothing
    assert order == ["shrink", "stage"]


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ends = result.agg(F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()
    assert ends[0] == ends[1]


def test_a_query_for_every_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    expected = oracle.sql(ORACLES[name])
    at = [expected.columns.index(c) for c in result.columns]
    rows = sorted(str(tuple(row[n] for n in at)) for row in expected.fetchall())
    assert sorted(str(tuple(row)) for row in result.collect()) == rows and rows
