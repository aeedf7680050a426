"""The join against comparing all pairs of sets, and components against a search."""

import random
import re
import tracemalloc
from collections import defaultdict

import pytest

from tidemark.llm import jaccard
from tidemark.llm.components import components
from tidemark.llm import shingles as shingles_module
from tidemark.llm.shingles import portions, shingle_sets, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[n:] for n in range(width)], strict=False))


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, width=3, percent=90):
    """(key, number of shingles, smallest key of the component) of each row (key, text)."""
    return [row[:3] for row in brute_components(rows, width, percent)]


def brute_components(rows, width=3, percent=90):
    sets = [shingles(text, width) for _, text in rows]
    links = [
        (a, b)
        for b in range(len(rows))
        for a in range(b)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(links, range(len(rows)))
    smallest = defaultdict(list)
    for n, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root[n]].append(key)
    return [
        (key, len(sets[n]), min(smallest[root[n]], default=None), root[n])
        for n, (key, _) in enumerate(rows)
    ]


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jaccard.jaccard_components(docs, **options)
    got = got.select("key", "n_shingles", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, **options)))
    return got


def test_given_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize(("width", "percent"), [(5, 80), (2, 60), (1, 100)])
def test_other_widths_and_similarities(spark, sf_dir, tricky, documents, width, percent):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=width, percent=percent)
    check(tricky, width=width, percent=percent)
    rng = random.Random(width)
    base = [f"w{n}" for n in range(60)]
    rows = []
    for n in range(60):  # similarities around the bound, from both sides, also of short texts
        words = base[: rng.choice([3, 5, 8, 20, 60])]
        for _ in range(rng.randint(0, 4)):
            words = [*words[: (at := rng.randrange(len(words)))], rng.choice(["x", "y"]), *words[at + 1 :]]
        rows.append((n, " ".join(words)))
    check(documents(rows), width=width, percent=percent)


def test_long_texts_are_taken_in_parts_between_words(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") * rng.randint(1, 30) for _ in range(300)), "x" * 500, "", "a  b "]
    whole = [(s.tolist()) for s, _ in shingle_sets(texts, 3)]
    for portion in (7, 64, 1000):
        monkeypatch.setattr(shingles_module, "PORTION", portion)
        shingles_module._POWERS.clear()
        assert [s.tolist() for s, _ in shingle_sets(texts, 3)] == whole
        assert not shingles_module._POWERS or len(shingles_module._POWERS[0]) == portion
    shingles_module._POWERS.clear()


def test_hashing_takes_little_memory():
    texts = ["some words of a text " * 40] * 3000
    shingles_module._POWERS.clear()
    tracemalloc.start()
    try:
        assert sum(len(word_hashes(some)[0]) for some in portions(texts)) == 600_000
        assert tracemalloc.get_traced_memory()[1] < 20_000_000
    finally:
        tracemalloc.stop()
        shingles_module._POWERS.clear()


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_around_the_limit(documents):
    """Chains and groups of copies with one to twelve changed words in 60 to 300."""
    rng = random.Random(11)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([11, 12, 60, 120, 300]))]
        rows.append(" ".join(base))
        for _ in range(12):
            text = rng.choice(rows[-5:]) if group % 2 else " ".join(base)
            rows.append(edited(rng, text.split(), rng.randrange(1, 5)))
    rng.shuffle(rows)
    check(documents(list(enumerate(rows))))


def test_group_that_shares_a_passage(documents):
    rng = random.Random(12)
    passage = " ".join(f"p{n}" for n in range(60))
    rows = [f"{passage} {edited(rng, ['x'] * 6, 6)}" for _ in range(80)]
    rows += [passage] * 5
    check(documents(list(enumerate(rows))))


def test_star_rounds_and_products_agree(documents, monkeypatch):
    rng = random.Random(13)
    base = [f"w{n}" for n in range(100)]
    docs = documents([(n, edited(rng, base, rng.randrange(6))) for n in range(120)])
    monkeypatch.setattr(jaccard, "PRODUCTS_PER_ENTRY", 0)
    check(docs)
    monkeypatch.setattr(jaccard, "PRODUCTS_PER_ENTRY", 10**9)
    check(docs)


def test_unlinked_long_texts_are_not_compared_in_full(documents, monkeypatch):
    """They share rare words at the front, and have more shingles than a short sketch has slots."""
    rng = random.Random(14)
    passage = " ".join(f"p{n}" for n in range(60))
    own = [" ".join(f"w{rng.randrange(4000)}" for _ in range(1960 + 30 * n)) for n in range(4)]
    rows = [f"{passage} {text}" for text in own]
    compared = []
    whole = jaccard._Join.sets_of

    def sets_of(join, pairs):
        compared.append(pairs.count())
        return whole(join, pairs)

    monkeypatch.setattr(jaccard._Join, "sets_of", sets_of)
    check(documents(list(enumerate(rows))), width=5, percent=80)
    assert compared == [0]
    # Sizes on both sides of a power of two: one sketch is folded.
    near = [edited(rng, own[2].split(), 3), " ".join(own[2].split()[:-60])]
    check(documents(list(enumerate([*rows, own[2], *near]))), width=5, percent=80)
    assert compared[1] > 0


def test_only_texts_of_wanted_keys_are_dealt_out(spark, documents):
    docs = documents([(n, str(n)) for n in range(500)] + [(None, "x"), (7, "again")])
    keys = spark.createDataFrame([(7,), (499,), (None,), (1000,)], "holder long")
    some, others = jaccard._parted(docs, docs["doc_id"], keys)
    assert some.columns == others.columns == docs.columns
    assert sorted(r.text for r in some.collect()) == ["499", "7", "again", "x"]
    assert others.count() == 498
    assert jaccard._parted(docs, docs["doc_id"], keys.limit(0))[1].count() == 502


def test_roots_meet_nodes_and_not_entries(documents):
    """A large group of near copies: every round adds a root to each node, not to its columns."""
    rng = random.Random(15)
    base = [f"w{n}" for n in range(200)]
    docs = documents([(n, edited(rng, base, 1)) for n in range(50)]).selectExpr("doc_id AS key", "text")
    rows = jaccard.rows_of(docs, 3, jaccard.word_levels(docs))
    classes = rows.withColumn("node", rows["key"])
    join = jaccard._Join(docs, 3, classes, 90)
    before = join.labelled()
    assert join.add(jaccard._all_pairs(before, 90))
    after = join.labelled()
    assert after.count() == before.count() > join.nodes.count() == join.nodes.distinct().count()
    assert after.select("root").distinct().count() < before.select("root").distinct().count()


def test_nulls_long_texts_and_repeated_rows(tricky):
    check(tricky)


def test_empty_table(nothing):
    assert jaccard.jaccard_components(nothing).count() == 0
    assert jaccard.one_of_each(nothing).count() == 0


def test_one_of_each_keeps_the_smallest_key(tricky):
    kept = jaccard.one_of_each(tricky)
    assert kept.columns == tricky.columns
    rows = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {root: c for _, n, c, root in brute_components(rows) if n}
    held = sorted((k for k, text in got if shingles(text)), key=str)
    assert held == sorted(groups.values(), key=str)
    assert sorted(map(str, (r for r in got if not shingles(r[1])))) == sorted(
        str(r) for r in rows if not shingles(r[1])
    )


@pytest.mark.parametrize("shape", ["path", "star", "random", "cycle"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(n, n + 1) for n in range(0, 90)],
        "star": [(50, n) for n in range(100) if n != 50],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "cycle": [(n, (n + 7) % 70) for n in range(70)],
    }[shape]
    rng.shuffle(links)
    nodes = {n for link in links for n in link}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in nodes} == roots(links, nodes)


def test_sets_have_the_sizes_of_exact_ones(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", "a", "a b", "A\x0bb", "É é", "a a a a a", "x" * 50_000]
    assert [len(s) for s, _ in shingle_sets(texts, 3)] == [len(shingles(t)) for t in texts]
