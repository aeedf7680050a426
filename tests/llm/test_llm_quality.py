"""The ledger against counting, and ablations against applying each policy again."""

import re
from collections import Counter

from tidemark.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[n : n + 3]) for n in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {n + k for n, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    chars = sum(map(len, words))
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), len(repeated)


def rows_of(docs):
    rows = quality.ledger(docs).select(
        "doc.text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", "failed",
    )
    return rows.collect()


def test_measurements(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = rows_of(docs)
    assert len(rows) == docs.count()
    assert all(tuple(row)[1:-1] == brute(row.text) for row in rows)


def test_nulls_long_texts_and_repeated_rows(tricky, documents):
    odd = ["a b c a b c", "a b c d a b c", "a a a a", "x y", "l\nl\nl\n \n", "a b c x a b c b c x"]
    docs = tricky.unionByName(documents(list(enumerate(odd))))
    rows = rows_of(docs)
    assert len(rows) == docs.count()
    assert all(tuple(row)[1:-1] == brute(row.text) for row in rows)


def test_policies_and_ablations(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = quality.ledger(docs)
    judged = quality.verdicts(ledger).collect()
    failed = [{rule for n, rule in enumerate(quality.RULES) if row.failed >> n & 1} for row in judged]
    for name, rules in quality.POLICIES.items():
        assert [row[f"kept_{name}"] for row in judged] == [not f & set(rules) for f in failed]
    rows = {(r.policy, r.rule): r for r in quality.ablations(ledger).collect()}
    assert set(rows) == {(p, r) for p, rules in quality.POLICIES.items() for r in rules}
    for (policy, rule), row in rows.items():
        rules = set(quality.POLICIES[policy])
        assert row.n_docs == len(failed)
        assert row.n_kept == sum(not f & rules for f in failed)
        assert row.n_failing == sum(rule in f for f in failed)
        without = sum(not f & (rules - {rule}) for f in failed)
        assert row.n_only == without - row.n_kept


def test_labelled_junk_goes_and_good_texts_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    judged = quality.verdicts(quality.ledger(docs))
    rows = judged.select("doc.quality", "kept_strict", "n_words").collect()
    good = [r.kept_strict for r in rows if r.quality == 1 and r.n_words >= 50]
    junk = [r.kept_strict for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(junk) / len(junk) < 0.05


def test_empty_table(nothing):
    assert quality.ledger(nothing).count() == 0
    assert quality.ablations(quality.ledger(nothing)).count() == 0
