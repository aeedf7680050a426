"""Token stores against encoding every text whole, and the hash against a dictionary."""

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.perfecthash import PerfectHash
from tidemark.llm.queries import TOKENIZER, token_table
from tidemark.llm import tokenstore, wordcodec
from tidemark.llm.tokenstore import TokenStore, bucket_of, write_store
from tidemark.llm.wordcodec import WordCodec
from tidemark.shared import fresh_folder

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def codec():
    return WordCodec(PATH, 2, most=25_000)


def encoded(codec, texts, end_id=None):
    ids, sizes = codec.encode(pa.array(texts, pa.string()), end_id)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def test_codec_equals_the_tokenizer_on_given_texts(spark, sf_dir, plain, codec):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert encoded(codec, texts) == list(map(plain, texts))


def test_codec_equals_the_tokenizer_on_odd_texts(tricky, plain, codec):
    texts = [r.text or "" for r in tricky.collect()]
    texts += ["İSTANBUL. ΟΔΟΣ, ǅ. é, ́x", "a b c d\u0085e", "''s 't.'re, 12.5,", "."]
    texts += ["<|startoftext|>x<|endoftext|>.", "<|StartOfText|>.", "a\x1c\x1d b\x1e.\x1f", "\x01 \x01. x\x01"]
    assert encoded(codec, texts) == list(map(plain, texts))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_codec_equals_the_tokenizer_on_any_text(texts):
    codec, tokenizer = WordCodec(PATH, 2), Tokenizer.from_file(PATH)
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    whole = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoded(codec, texts) == whole


def test_words_of_letters_go_to_the_model_at_once(plain, monkeypatch):
    """Whole texts are not normalized and cut for them; any other tokenizer cuts as before."""
    words = ["house", "été", "straße", "ÿþ", "xqzwv" * 9, "o\u0308l", "ŝ", "ª", "don't", "ı", "÷", "ﬁne"]
    texts = pa.array([*words, " ".join(words), wordcodec.LETTERS])
    expected = [i for text in texts.to_pylist() for i in plain(text)]
    asked = []
    whole = WordCodec._ids

    def ids(codec, text):
        asked.append(text)
        return whole(codec, text)

    monkeypatch.setattr(WordCodec, "_ids", ids)
    codec = WordCodec(PATH, 2)
    assert codec.encode(texts)[0].tolist() == expected
    assert not any(word in text for text in asked for word in ("house", "été", "straße"))
    monkeypatch.setattr(WordCodec, "_pieces", lambda codec: {})
    assert WordCodec(PATH, 2).encode(texts)[0].tolist() == expected
    assert any("straße" in text for text in asked)


def test_end_id_follows_every_text(plain, codec):
    texts = ["", "a b", " ", "", "c"]
    assert encoded(codec, texts, 7) == [[*plain(t), 7] for t in texts]
    sliced = pa.array(["x y", *texts]).slice(1)
    assert codec.encode(sliced, 7)[1].tolist() == [len(plain(t)) + 1 for t in texts]


def test_words_are_placed_some_at_a_time(plain, codec, monkeypatch):
    texts = ["", "a b c d e f g", "h", " ", "", "i, j. k", ""]
    whole = encoded(codec, texts, 7)
    monkeypatch.setattr(wordcodec, "PLACED", 2)
    assert encoded(codec, texts, 7) == whole == [[*plain(t), 7] for t in texts]
    assert encoded(codec, texts) == [plain(t) for t in texts]
    assert codec.encode(pa.array([], pa.string()), 7)[0].tolist() == []


def test_placing_words_takes_little_memory(codec):
    texts = pa.array(["one and two and three " * 200] * 1000)
    codec.encode(texts, 7)
    tracemalloc.start()
    ids, _ = codec.encode(texts, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * ids.nbytes + 60 * wordcodec.PLACED


@pytest.mark.parametrize("chunk, memory", [(1, 0), (100, 1000)])
def test_chunks_and_memory_change_no_result(spark, tricky, plain, chunk, memory):
    rows = tricky.select("doc_id", "text").collect()
    got = token_table(spark, tricky, chunk=chunk, memory=memory).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, token_table(spark, tricky).collect()), key=key)
    assert sum(r.n_tokens for r in got) == sum(len(plain(r.text)) + 1 for r in rows)


def brute(rows, encode):
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for row in order:
        ids = np.array([*encode(row.text), 1], "<u4")
        out.append((row.doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_read_back_equals_brute_force(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = token_table(spark, docs.repartition(5)).collect()
    assert sorted(map(tuple, got)) == brute(docs.collect(), plain)


def test_nulls_long_texts_and_repeated_rows(spark, tricky, plain):
    """Rows of one key may stand in any order, but back to back and each whole."""
    rows = tricky.collect()
    got = [tuple(r) for r in token_table(spark, tricky).collect()]
    expected = brute(rows, plain)
    content = [(key, n, crc) for key, _, n, crc in expected]
    assert sorted(((k, n, c) for k, _, n, c in got), key=str) == sorted(content, key=str)
    ends = 0
    for key, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == ends
        ends += n
        first = [r[1] for r in expected if r[0] == key]
        assert min(first) <= start
    assert ends == sum(r[2] for r in expected)


def test_one_key_over_several_shards(spark, documents, plain):
    texts = [f"text number {n} " * 20 for n in range(60)]
    docs = documents([(1, "first"), *[(5, t) for t in texts], (9, "last")]).repartition(4)
    root = fresh_folder(spark, "tokens")
    write_store(docs, root, PATH, shards=4)
    store = TokenStore(spark, root)
    assert store.shards().count() == 4
    assert sorted(store.get(5)) == sorted([*plain(t), 1] for t in texts)
    assert store.get(9) == [[*plain("last"), 1]] and store.get(4) == [] and store.get(None) == []
    keys = spark.createDataFrame([(1,), (5,), (6,)], "key long")
    assert store.documents(keys).count() == 61


def test_one_key_is_found_without_a_job_and_by_few_small_reads(spark, documents, plain, monkeypatch):
    docs = documents([(n, f"text number {n}") for n in range(9000)])
    root = fresh_folder(spark, "tokens")
    write_store(docs, root, PATH, shards=6)
    store, reads = TokenStore(spark, root), []
    assert store.buckets == 3

    class Counting:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def open_input_file(self, path):
            file = self.files.open_input_file(path)

            class Open:
                __enter__ = lambda own: own
                __exit__ = lambda own, *a: file.close()

                @staticmethod
                def read_at(size, at):
                    reads.append((path.rsplit("/", 2)[-2], size))
                    return file.read_at(size, at)

            return Open()

    opened = tokenstore._opened
    monkeypatch.setattr(tokenstore, "_opened", lambda r: (Counting(opened(r)[0]), opened(r)[1]))
    monkeypatch.setattr(spark, "_jsparkSession", None)  # any job would fail
    for key in (0, 4321, 8999):
        reads.clear()
        assert store.get(key) == [[*plain(f"text number {key}"), 1]]
        assert [folder for folder, _ in reads] == ["index", "index", root.rsplit("/", 1)[1], "shards", "shards"]
        assert sum(size for _, size in reads) < 200_000
    reads.clear()
    assert store.get(123456789) == [] and len(reads) == 2


@settings(max_examples=100, deadline=None)
@given(st.integers(-(2**63), 2**63 - 1), st.integers(1, 10**6))
def test_buckets_of_single_keys_are_in_range(key, buckets):
    assert 0 <= bucket_of(key, buckets) < buckets


def test_buckets_of_single_keys_are_those_of_columns(spark):
    keys = [None, 0, 1, -1, 42, 2**63 - 1, -(2**63), 123456789012345]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    got = [r[0] for r in frame.select(tokenstore._bucket(977)).collect()]
    assert got == [bucket_of(k, 977) for k in keys]


def test_near_documents_are_read_at_once():
    places = [(0, 10), (10, 5), (15, 0), (100_000, 3), (100_003, 9_000_000), (9_100_003, 1)]
    got = [(first, end, some) for first, end, some in tokenstore._stretches(places)]
    assert got == [(0, 15, [0, 1, 2]), (100_000, 100_003, [3]), (100_003, 9_100_003, [4]), (9_100_003, 9_100_004, [5])]


def test_long_texts_are_encoded_in_parts(spark, documents, plain):
    words = " ".join(f"word{n % 977}, and" for n in range(800_000))
    root = fresh_folder(spark, "tokens")
    write_store(documents([(1, words), (2, "x" * 5_000_000 + " y"), (3, "end")]), root, PATH)
    store = TokenStore(spark, root)
    assert store.get(1) == [[*plain(words), 1]] and store.get(3) == [[*plain("end"), 1]]
    assert store.get(2) == [[*plain("x" * 5_000_000 + " y"), 1]]


def test_copies_of_one_row_lie_in_several_shards(spark, documents):
    docs = documents([(7, "the same words again")] * 4000 + [(n, "other") for n in range(8, 40)])
    root = fresh_folder(spark, "tokens")
    write_store(docs.repartition(6), root, PATH, shards=4)
    runs = spark.read.parquet(f"{root}/runs").where("key = 7")
    assert runs.agg(F.max("n_records")).first()[0] < 2000
    store = TokenStore(spark, root)
    assert len(store.get(7)) == 4000
    keys = spark.createDataFrame([(7,)], "key long")
    assert sorted(r.start for r in store.documents(keys).collect()) == [5 * n for n in range(4000)]


def test_null_key_is_found(spark, documents, plain):
    root = fresh_folder(spark, "tokens")
    write_store(documents([(None, "lost"), (3, None)]), root, PATH)
    store = TokenStore(spark, root)
    assert store.get(None) == [[*plain("lost"), 1]] and store.get(3) == [[1]]


def test_empty_table(spark, nothing):
    assert token_table(spark, nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), np.int64)
    table = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(table.find(keys)) == list(range(len(keys)))


def test_hash_turns_unknown_keys_away():
    table = PerfectHash.build(np.arange(0, 200_000, 2))
    assert (table.find(np.arange(1, 200_000, 2)) == -1).all()
    assert len(table.to_bytes()) < 100_000 * 5
