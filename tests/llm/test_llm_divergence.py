"""Source divergence against counting with whole dictionaries."""

import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import divergence
from tidemark.llm.divergence import document_counts, source_divergence

WORDS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORDS.findall(text.translate(LOWER))


def brute(rows, least=3, top=200):
    docs = [tuple(v or "" for v in row) for row in rows]
    often, in_docs = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang, source) for _, lang, source in docs}
    for text, lang, source in docs:
        found = terms(text)
        often[lang, source].update(found)
        often[lang].update(found)
        in_docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in in_docs[lang].items() if n >= least]

        def shares(key, kept=kept):
            total = sum(often[key][t] for t in kept)
            return {t: 1 + 10**9 * (often[key][t] + 1) // (total + len(kept)) for t in kept}

        own, whole = shares((lang, source)), shares(lang)
        pairs = []
        for other in {s for g, s in groups if g == lang} - {source}:
            q = shares((lang, other))
            pairs.append((other, sum((own[t] - q[t]) ** 2 // q[t] for t in kept)))
        more = [
            (t, (own[t] - whole[t]) ** 2 // whole[t])
            for t in kept
            if often[lang, source][t] and own[t] > whole[t]
        ]
        for part, items in (("pair", pairs), ("term", more)):
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [
                (lang, source, part, item, value, rank)
                for rank, (item, value) in enumerate(items, 1)
                if part == "pair" or rank <= top
            ]
    return sorted(out)


def check(docs, **options):
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    got = sorted(tuple(r) for r in source_divergence(docs, **options).collect())
    assert got == brute(rows, **{"least": options.get("least_docs", 3), "top": options.get("top", 200)})
    return got


def test_given_documents(spark, sf_dir):
    got = check(spark.read.parquet(f"{sf_dir}/documents.parquet"), top=7)
    assert {row[2] for row in got} == {"pair", "term"}


def test_nulls_long_texts_repeated_rows_and_clashing_names(tricky):
    assert check(tricky, least_docs=2)
    check(tricky)


def test_a_language_without_terms_has_pairs_of_value_zero(documents):
    docs = documents([(n, "1 2 3", "xx", f"s{n}") for n in range(3)] + [(9, None, None, None)])
    got = check(docs)
    assert [row[4:] for row in got if row[0] == "xx"] == [(0, 1), (0, 2)] * 3


def test_ties_go_to_the_item_that_sorts_first(documents):
    rows = [(n, "zeta alpha éta", "en", f"s{n % 2}") for n in range(6)]
    rows += [(10, "other other other", "en", "s0")] * 3
    check(documents(rows), least_docs=1, top=2)


def test_empty_table(nothing):
    assert source_divergence(nothing).count() == 0


def test_small_tasks_flush_and_long_texts_are_split_in_pieces(spark, documents, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "Some words, some WORDS and some more; " * 40
    assert document_counts(text.encode()) == Counter(t.encode() for t in terms(text))
    check(documents([(n, text + f"w{n % 3}", "en", f"s{n % 2}") for n in range(9)]))


@pytest.mark.parametrize("text", ["", " ", "A-Z é È \x80 ﻿ x", "漢字 don't"])
def test_the_table_reads_words_as_the_pattern_does(text):
    assert document_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def test_a_term_of_many_sources_over_batches(spark, documents):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(n, f"common term t{n % 4} word{n % 9}", "en", f"s{n % 23}") for n in range(120)]
        check(documents(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
