"""Decontamination against looking for every window in every document."""

import random
import re

from tidemark.llm.decontaminate import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items):
    own = words(text)
    hit, held = set(), set()
    for item, item_text in items:
        w = words(item_text)
        for n in range(max(len(w) - 12, 1)):
            window = w[n : n + 13]
            for at in range(len(own) - len(window) + 1):
                if window and own[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    held.add("" if item is None else str(item))
    bad = bool(hit) and 20 * len(hit) >= len(own)
    return len(own), len(hit), sorted(held), bad


def check(docs, items):
    found = decontaminate(docs, items)
    got = found.select("doc.doc_id", "doc.text", "n_words", "n_hit", "items", "contaminated")
    held = [tuple(row) for row in items.select("item_id", "text").collect()]
    rows = got.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert (row.n_words, row.n_hit, row["items"], row.contaminated) == brute(row.text, held)
    return rows


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, row string")


def test_passages_of_all_lengths(spark, documents):
    rng = random.Random(3)
    pool = [f"w{n}" for n in range(60)]

    def say(n):
        return " ".join(rng.choice(pool) for _ in range(n))

    rows = [(n, say(rng.choice([1, 2, 4, 5, 6, 12, 13, 14, 40]))) for n in range(30)]
    rows += [(30, None), (31, "..."), (None, rows[3][1]), (4, say(20))]
    texts = []
    for n in range(60):
        inside = rng.choice(rows)[1] or ""
        inside = inside.upper() if n % 3 else inside.replace(" ", " - ")
        texts.append((n, f"{say(rng.randrange(300))} {inside} {say(rng.randrange(300))}"))
    found = check(documents(texts), items_of(spark, rows))
    assert any(row.contaminated for row in found) and any(row.n_hit > 13 for row in found)


def test_nulls_long_texts_and_repeated_rows(spark, tricky):
    base = tricky.where("doc_id = 20").first().text
    rows = [(1, base), (2, "two words"), (3, "word"), (4, " ".join(base.split()[5:20]))]
    check(tricky, items_of(spark, rows))


def test_overlapping_windows_count_each_word_once(spark, documents):
    found = check(documents([(1, "a b " * 50)]), items_of(spark, [(1, "a b a b"), (2, "b a b")]))
    assert found[0].n_hit == found[0].n_words == 100


def test_empty_tables(spark, nothing, tricky):
    items = items_of(spark, [(1, "one two three")])
    assert decontaminate(nothing, items).count() == 0
    clean = decontaminate(tricky, items.limit(0))
    assert clean.count() == tricky.count() and clean.where("n_hit > 0 or contaminated").count() == 0
