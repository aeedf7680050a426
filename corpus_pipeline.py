"""The corpus pipeline: five operators in a row, each over what the one before kept.

Every stage takes and, but for the last, returns rows of documents. It is given what the stage
before returned, written and read again; it then deletes what that stage had staged on its way.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import forget, shrink_heaps, staging
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard import one_of_each
from tidemark.llm.langid import language_id
from tidemark.llm.mixing import mixed
from tidemark.llm.queries import token_table
from tidemark.shared import delete_path, fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates share this percentage of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Bytes that the token store encodes at a time and of words that it remembers: by the last
#: stage the executors' JVMs have grown to their limit and leave little to Python.
TOKEN_CHUNK, TOKEN_MEMORY = 2_000_000, 60_000_000
#: Folders that the stage before has staged.
_LEFT: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """A stage that deletes what the one before has staged, whose result is written by now, and
    begins with heaps that have given back what that one's left in them."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget(spark, _LEFT)
        shrink_heaps(spark)
        with staging() as folders:
            result = stage(spark, docs, sf_dir)
        _LEFT.extend(folders)
        return result

    return run_stage


@_tidy
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models do not reject.

    Null texts and texts without a letter go, as they are in no language. A null ``lang`` is
    not learned from; the document is judged all the same. Repeated rows are judged alike and
    all stay or go. Without any label, and for an empty table, nothing stays.
    """
    return language_id(docs).where("not rejected").select("doc.*")


@_tidy
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest key.

    Links are similarities of 0.8 or more between sets of five-word shingles. Null and empty
    texts are copies of nothing and stay. Of rows with one key the text that hashes lowest
    counts as first, of rows that are repeated whole one stays; a null key comes last. An empty
    table gives an empty one.
    """
    return one_of_each(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)


@_tidy
def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and empty texts, and all texts if the benchmark is empty, are clean. Repeated rows are
    judged alike. An empty table gives an empty one.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).where("not contaminated").select("doc.*")


@_tidy
def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, twice at most.

    A null source is a source of its own, the last one. Documents without a word take nothing
    from a budget. Repeated rows are rows of their own. An empty table gives an empty one.
    """
    return mixed(docs)


@_tidy
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' place in the token store, as read back from it, a row for each row.

    Null and empty texts have the end id alone. Rows of one key stand one after the other, null
    keys first. An empty table gives an empty one.
    """
    return token_table(spark, docs, chunk=TOKEN_CHUNK, memory=TOKEN_MEMORY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("jaccard", distinct_documents),
    ("decontaminate", clean_documents),
    ("mixing", mixed_documents),
    ("tokens", tokens),
]

#: Character models and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; each stage's result is written to the
    shared folder, read again by the next, and deleted when that one's is written."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        result, before = stage(spark, docs, sf_dir), path
        path = fresh_folder(spark, f"pipeline-{name}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            delete_path(spark, before)
    forget(spark, _LEFT)
    return docs
