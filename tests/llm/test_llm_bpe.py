"""Ids against the tokenizers library, texts against a round trip."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    encoded = bpe.encode(docs, PATH, keep=("doc_id", "text"), **options)
    got = [(r.row.doc_id, r.row.text, r.ids) for r in encoded.collect()]
    assert sorted(got, key=str) == sorted(((k, t, ids(t)) for k, t in rows), key=str)
    back = bpe.decode(encoded, PATH).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r.text == (r.row.row.text or "")


def test_given_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_nulls_long_texts_repeated_rows_and_clashing_names(tricky):
    check(tricky)


def test_empty_table(nothing):
    check(nothing)


def test_small_blocks_and_batches(spark, tricky):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        check(tricky.where("length(text) < 5000 or text is null"), block_bytes=500)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_block_of_more_words_than_two_bytes_number(spark, documents):
    check(documents([(1, " ".join(f"w{n}" for n in range(70_000))), (2, "w1 w2"), (3, None)]))


SIGNS = st.sampled_from(
    list(" \n\t\r.,;:!?'\"-_#<|>aZ09éß漢 \u0085 ᠎ ​ 　﻿🙂\x00\x1ć")
    + ["'s", "'ll", "  ", "<|endoftext|>", " the", "\r\n", "don't", "3.14", "word"]
)


def test_texts_of_any_signs(spark, documents):
    texts = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(st.lists(SIGNS, max_size=25).map("".join))
    def gather(text):
        texts.append(text)

    gather()
    check(documents(list(enumerate(texts))))


def test_decoding_of_ids_that_are_no_text(spark):
    cases = [[50256, 0], [220, 999_999, 0], [], None, [220] * 3, [237], [47728, 99, 11]]
    rows = spark.createDataFrame(list(enumerate(cases)), "row int, ids array<int>")
    for r in bpe.decode(rows, PATH).collect():
        want = cases[r.row.row] or []
        assert r.text == LIBRARY.decode(want, skip_special_tokens=False)


def words(texts):
    found, counts = bpe.words_of(pa.array([t.encode() for t in texts], pa.binary()))
    ends = np.cumsum([0, *counts])
    return [found.slice(a, b - a).to_pylist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def test_words_put_together_are_the_text(monkeypatch, tricky):
    texts = [r.text or "" for r in tricky.collect()] + ["", "a", " ", "a b", "a1-b's <|endoftext|>."]
    whole = words(texts)
    assert ["".join(own) for own in whole] == texts
    assert whole[-1] == ["a", "1", "-", "b's", " <|endoftext|>", "."] or "".join(whole[-1]) == texts[-1]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(bpe, "SLICE", size)
        short = [t for t in texts if len(t) < 3000]
        assert words(short) == [own for own, t in zip(whole, texts, strict=True) if len(t) < 3000]
    sliced = pa.array([t.encode() for t in texts], pa.binary()).slice(3, 4)
    assert bpe.words_of(sliced)[0].to_pylist() == sum(whole[3:7], [])


def test_equal_words_of_all_blocks_are_encoded_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs.repartition(5), block_bytes=40_000)
    read = docs.select(F.struct("doc_id").alias("row"), F.col("text").cast("binary").alias("text"))
    entries = bpe.distinct_words(read, 40_000).collect()
    assert len({r.block for r in entries}) > 5 and len({(r.block, r.part) for r in entries}) == len(entries)
    parts = {}
    for r in entries:
        own = bpe._values_of(bpe._unpacked(r["sizes"]), bpe._whole(r["words"]), pa.string()).to_pylist()
        assert len(set(own)) == len(own)
        for word in own:
            assert parts.setdefault(word, r.part) == r.part
    whole = words([r.text or "" for r in docs.collect()])
    assert set(parts) == {w for own in whole for w in own}


def test_texts_that_are_read_differently_raise(spark):
    rows = spark.range(200).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.rand().cast("string")).alias("text")
    )
    rand = F.udf(lambda _: __import__("random").random(), "double").asNondeterministic()
    rows = rows.withColumn("text", F.concat("text", rand("doc_id").cast("string")))
    with pytest.raises(Exception, match="not alike"):
        bpe.encode(rows, PATH).count()


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op13_bpe"](spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        own = ids(texts[r.doc_id])
        assert r.n_tokens == len(own)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_a_tokenizer_file_is_read_where_it_lies():
    with pytest.raises(Exception, match="No such file"):
        bpe.pieces("/nowhere/file.json")
