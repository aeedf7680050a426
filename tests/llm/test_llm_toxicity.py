"""The fit against numerical gradients and known weights, and labelled documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import toxicity


def test_known_weights_are_found():
    rng = np.random.default_rng(4)
    n, width = 4000, 6
    x = (rng.random((n, width)) < 0.3).astype(float)
    weights, thresholds = np.array([3.0, -2.0, 1.0, 0, 0, 0]), np.array([0.5, 2.5])
    noise = rng.logistic(size=n)
    grades = ((x @ weights + noise)[:, None] > thresholds).sum(axis=1)
    rows, columns = np.nonzero(x)
    found, edges = toxicity.fit_ordinal(rows, columns, x[rows, columns], grades, width)
    assert found == pytest.approx(weights, abs=0.35) and edges == pytest.approx(thresholds, abs=0.3)


def test_probabilities_and_expected_severity():
    model = toxicity.OrdinalModel({"bad": 2.0}, np.array([1.0, 3.0]))
    one, two = 1 / (1 + np.exp(-1.0)), 1 / (1 + np.exp(1.0))
    row = toxicity._judged(model, ["a BAD day"]).iloc[0]
    assert row.severity == pytest.approx(one + two) and row.toxic
    assert row.grade == np.argmax([1 - one, one - two, two])
    assert model.score("bad bad") == 4.0 and model.score("bad " * 100) == 2.0 * 4


def test_grades_rise_with_marks():
    marks, n = [1, 2, 3, 4, 5, 9], 66
    toxic = np.arange(n) < len(marks)
    sample = toxicity.Sample(
        ["^scumm", "day", "scum"],
        np.array([6, 6, 6]),
        np.array([0, 60, 0]),
        6,
        60,
        toxic,
        np.ones(n),
        np.concatenate([np.arange(6), np.arange(6), np.arange(n)]),
        np.repeat([2, 0, 1], [6, 6, n]),
        np.concatenate([marks, np.full(6, 50), np.full(n, 2)]),
    )
    assert sample.grades().tolist() == [1, 1, 1, 1, 2, 2] + [0] * 60


def test_words_and_stems():
    found = toxicity.word_counts("Réunion, réunions! OK 42")
    assert found == {"réunion": 1, "réunions": 1, "ok": 1, "^réuni": 2}


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, rest = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    judged = toxicity.grade_toxicity(docs, train).select("doc.doc_id", "severity", "toxic")
    rows = judged.join(rest.withColumnRenamed("toxic", "label"), "doc_id").collect()
    caught = [r.toxic for r in rows if r.label == 1]
    alarms = [r.toxic for r in rows if r.label == 0]
    assert len(caught) > 80 and sum(caught) / len(caught) > 0.9
    assert sum(alarms) / len(alarms) < 0.01
    assert all(0 <= r.severity <= 2 for r in rows)


def labelled(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, toxic int, quality int, text string")


def test_nulls_long_texts_and_repeated_rows(spark, tricky, documents):
    rng = random.Random(2)
    plain = " ".join(f"w{n % 40}" for n in range(60))
    known = [(1000 + n, plain + (" scum" * (1 + n % 8) if n % 3 == 0 else ""), "en", "s") for n in range(90)]
    rng.shuffle(known)
    docs = tricky.unionByName(documents([*known, (2000, "SCUM! scum. " * 20_000, "en", "s")]))
    labels = [(key, int("scum" in text)) for key, text, _, _ in known]
    labels += [(None, 1), (1, None), (4, 0), (4, 0), (777, 1), (1, 1)]
    got = toxicity.grade_toxicity(docs, labelled(spark, labels))
    assert got.count() == docs.count()
    rows = {r.doc_id: r for r in got.select("doc.doc_id", "severity", "grade", "toxic").collect()}
    assert rows[2000].toxic and rows[2000].grade == 2 and not rows[7].toxic and not rows[2].toxic
    assert rows[1].severity == rows[2].severity


def brute_counts(rows, label):
    """Toxic and other labelled documents that have each feature."""
    inside, outside = Counter(), Counter()
    for key, text in rows:
        if key in label and text is not None:
            (inside if label[key] else outside).update(toxicity.word_counts(text).keys())
    return inside, outside


def test_features_and_results_follow_from_all_labelled_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    label = {r.doc_id: r.toxic > 0 for r in labels.collect() if r.toxic is not None}
    inside, outside = brute_counts(rows, label)
    n_clean = sum(not label[k] for k, t in rows if k in label)
    expected = {
        f for f in inside.keys() | outside.keys()
        if inside[f] + outside[f] >= toxicity.LEAST_DOCS and outside[f] <= toxicity.MOST_SHARE * n_clean
    }
    for most in (16_000, 30):  # the sample does not decide what is a feature
        sample = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", most)
        assert set(sample.features) == expected
        assert [inside[f] for f in sample.features] == sample.inside.tolist()
        assert [outside[f] for f in sample.features] == sample.outside.tolist()
        assert (sample.n_toxic + sample.n_clean, sample.n_clean) == (sum(k in label for k, _ in rows), n_clean)
    assert len(sample.toxic) < 80

    whole = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 16_000)
    model = whole.fit()
    got = toxicity.grade_toxicity(docs, labels).select("doc.doc_id", "severity", "grade", "toxic")
    for r in got.collect():
        words = Counter(re.findall(r"[^\W\d_]+", (dict(rows)[r.doc_id] or "").lower()))
        stems = Counter()
        for word, n in words.items():
            if len(word) > 5:
                stems["^" + word[:5]] += n
        score = sum(
            model.weights.get(f, 0.0) * (1 + math.log2(min(n, 8))) for f, n in (words + stems).items()
        )
        above = [1 / (1 + math.exp(-max(min(score - t, 40), -40))) for t in model.thresholds]
        edges = [1.0, *above, 0.0]
        assert r.severity == pytest.approx(sum(above)) and r.toxic == (above[0] > 0.5)
        assert r.grade == max(range(len(above) + 1), key=lambda k: edges[k] - edges[k + 1])


def test_one_document_with_a_third_of_all_rows_is_one_entry(spark, documents):
    plain = " ".join(f"w{n % 40}" for n in range(60))
    known = [(n, f"{plain} {'scum' if n % 3 == 0 else 'good'} x{n % 5}", "en", "s") for n in range(90)]
    docs = documents(known + [(0, known[0][1], "en", "s")] * 45).repartition(6)
    labels = labelled(spark, [(key, int("scum" in text)) for key, text, _, _ in known])
    sample = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 16_000)
    assert len(sample.toxic) == 90 and sorted(sample.times)[-1] == 46 and sample.times.sum() == 135
    assert sample.n_toxic == 30 + 45


def test_small_tasks_pass_their_counts_on(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    rows = docs.selectExpr("doc_id % 3 = 0 as toxic", "text").repartition(3)
    got = {r.feature: (r.inside, r.outside) for r in toxicity.feature_counts(rows, held=50).collect()}
    inside, outside = brute_counts(
        [(r.doc_id, r.text) for r in docs.collect()], {r.doc_id: r.doc_id % 3 == 0 for r in docs.collect()}
    )
    assert got == {f: (inside[f], outside[f]) for f in inside.keys() | outside.keys()}


def test_nothing_to_learn(spark, tricky, nothing):
    for rows in ([], [(4, 0)], [(4, 1)]):
        judged = toxicity.grade_toxicity(tricky, labelled(spark, rows))
        assert judged.count() == tricky.count()
        assert {r.severity for r in judged.collect()} == {0.0}
    assert toxicity.grade_toxicity(nothing, labelled(spark, [(1, 1)])).count() == 0
