"""Parts, rules and verdicts against plain Python; trees on labels they can learn."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import urlfilter
from tidemark.llm.urlfilter import ALLOW, BLOCK, RULES, Rule, judge_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(url):
    host, path = split(url)
    fits = [
        r for r in RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return best and (best.host + best.path, best.verdict)


def check(pages, **options):
    got = judge_urls(pages, **options).join(pages.select("page_id", "url"), "page_id").collect()
    for row in got:
        assert (row.host, row.path) == split(row.url)
        expected = rule_of(row.url)
        assert row.rule == (expected and expected[0])
        assert row.verdict == expected[1] if expected else row.verdict in (ALLOW, BLOCK)
        assert 0 <= row.risk <= 1
    return got


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert len(check(pages)) == pages.count()


ODD = [
    None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en",
    "http://example.com/en/", "https://a.example.com/en/?q=://b", "http://notexample.com/en/1",
    "http://x.net/fr/1#é", "ftp://net/es/", "http://com", "http://com/", "http://ÄB.com/ü/\n2",
    "http://a.org/" + "9" * 100_000, "http://www.example.com/en/1", "http://m.www.example.com/en/",
]


def frame(spark, urls):
    schema = "page_id long, url string, host string, features string, label string"
    return spark.createDataFrame([(n, u, "x", "y", "z") for n, u in enumerate(urls)], schema)


def test_nulls_odd_long_and_repeated_urls(spark):
    pages = frame(spark, ODD * 2)
    assert len(check(pages)) == 2 * len(ODD)


def test_one_kind_of_label_none_and_nothing(spark):
    only = judge_urls(frame(spark, ["http://x.com/", "http://x.org/"]))
    assert {r.verdict for r in only.collect()} == {ALLOW}
    only = judge_urls(frame(spark, ["http://x.net/es/", "http://x.org/"]))
    assert {r.verdict for r in only.collect()} == {BLOCK}
    assert judge_urls(frame(spark, ["http://x.org/"])).first().verdict == ALLOW
    assert judge_urls(frame(spark, [])).count() == 0


def test_entropy(spark):
    texts = ["", "aaaa", "abab", "http://x.com/é🙂"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in rows.select("t", urlfilter.entropy(F.col("t")).alias("e")).collect():
        n = len(row.t)
        expected = -sum(c / n * math.log2(c / n) for c in Counter(row.t).values())
        assert row.e == pytest.approx(expected, abs=1e-9)


def test_trees_learn_lexical_features(spark):
    """Blocked URLs are deep and full of digits; unlabelled ones are judged alike."""
    rules = (Rule(BLOCK, "bad.test", ""), Rule(ALLOW, "good.test", ""))
    urls = []
    for n in range(400):
        deep = n % 2 == 0
        path = "/".join(str(n * k + 10_000) for k in range(6)) if deep else f"about-us-{'abc'[n % 3]}"
        suffix = "other.example" if n % 4 < 2 else "bad.test" if deep else "good.test"
        urls.append(f"http://h{n % 7}.{suffix}/{path}")
    got = judge_urls(frame(spark, urls), rules=rules, training_rows=150).collect()
    unknown = [r for r in got if r.rule is None]
    right = [(r.verdict == BLOCK) == (r.path.count("/") > 3) for r in unknown]
    assert len(unknown) == 200 and sum(right) / len(right) > 0.9


def test_held_out_hosts_are_judged_better_than_by_a_constant(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = urlfilter.held_out_accuracy(pages)
    assert found["urls"] > 50 and found["trees"] >= found["constant"]


def test_a_url_with_a_third_of_all_rows_is_one_row_of_the_sample(spark):
    urls = [f"http://h{n}.x.com/" for n in range(60)] + [f"http://h{n}.net/fr/a{n}" for n in range(60)]
    pages = frame(spark, urls + [urls[0]] * 60).repartition(5)
    known = urlfilter._labelled(urlfilter._read(pages, "page_id", "url", RULES))
    assert sorted(r.copies for r in known.collect())[-2:] == [1, 61] and known.count() == 120
    rows = judge_urls(pages).where("host = 'h0.x.com'").collect()
    assert len(rows) == 61 and len({r.risk for r in rows}) == 1


def test_a_url_does_not_count_in_its_own_statistics(spark):
    urls = ["http://a.net/fr/1", "http://b.net/fr/2", "http://a.net/es/3", "http://c.com/"]
    known = urlfilter._labelled(urlfilter._read(frame(spark, urls), "page_id", "url", RULES))
    found = urlfilter.described(known, urlfilter.suffix_statistics(known), 0.75)
    rows = {r.url: r for r in found.collect()}
    prior = 0.75 * urlfilter.PRIOR
    assert rows[urls[0]].share_1 == pytest.approx((2 + prior) / (2 + urlfilter.PRIOR))
    assert rows[urls[0]].count_2 == pytest.approx(math.log(2)) and rows[urls[1]].count_2 == 0
    assert rows[urls[3]].share_1 == pytest.approx(prior / urlfilter.PRIOR)
