"""Toxicity as a severity grade, by cumulative-link ordinal regression.

A document's score is a sum of weights of its words and stems (the first letters of longer
words, which inflected forms share). One set of weights serves all
grades: the probability of grade k or more is logistic in the score less a threshold that
rises with k. The expected severity is the sum of those probabilities.

Labels say toxic or not. Severity among toxic documents is read off the labelled documents
themselves: words far more frequent in toxic documents mark them, and documents with many
marks get the higher grade. Which words are features and which are marks follows from counts
over all labelled documents; only the weights are fitted to a sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, small_batches, staged

#: Labelled documents that the weights are fitted to, at most (about).
TRAINING_DOCS = 16_000
#: A word or stem is a feature if so many labelled documents have it, but no more than this
#: share of those that are not toxic; of more features than MOST_FEATURES those stay whose
#: shares of toxic and of other documents differ most.
LEAST_DOCS, MOST_SHARE, MOST_FEATURES = 5, 0.1, 200_000
#: Labels that may be broadcast (a key and a mark each, some tens of bytes in memory).
MOST_BROADCAST = 2_000_000
#: Features that a task counts before it passes them on.
HELD = 300_000
#: A mark is a word in so many toxic documents, and so many times as frequent there.
MARK_DOCS, MARK_RATIO = 5, 10.0
#: Toxic documents with so many marks have the highest grade.
SEVERE_MARKS = 5
#: Penalty on the sum of absolute weights of the mean log-likelihood, rounds and step of the fit.
PENALTY, ROUNDS, STEP = 2e-4, 300, 0.3
#: Words repeated more often than this in a document add nothing more.
MOST_REPEATS = 8
WORDS = re.compile(r"[^\W\d_]+")


#: Letters of a stem; stems are told from words by the mark before them.
STEM, STEM_MARK = 5, "^"


def word_counts(text: str) -> Counter:
    """How often a text has each word and each stem."""
    words = Counter(WORDS.findall(text.lower()))
    stems = Counter()
    for word, n in words.items():
        if len(word) > STEM:
            stems[STEM_MARK + word[:STEM]] += n
    return words + stems


def strength(counts: np.ndarray) -> np.ndarray:
    """The value of a feature: 1 for one occurrence, growing with the logarithm."""
    return 1 + np.log2(np.minimum(counts, MOST_REPEATS))


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: np.ndarray

    def score(self, text: str) -> float:
        held = ((n, self.weights.get(of)) for of, n in word_counts(text).items())
        return sum(w * float(strength(np.float64(n))) for n, w in held if w is not None)

    def exceedance(self, scores: np.ndarray) -> np.ndarray:
        """Probability of grade 1 or more, 2 or more, ... for each score."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    grades: np.ndarray,
    n_columns: int,
    times: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds that maximise the mean log-likelihood of the cumulative
    logit model less the penalty, by steps that shrink with each weight's own gradients.

    Entry i of the sparse matrix is ``values[i]`` at (``rows[i]``, ``columns[i]``). Row j counts
    ``times[j]`` times, or once.
    """
    n, top = len(grades), int(grades.max())
    index = np.arange(n)
    weight = np.ones(n) / n if times is None else times / times.sum()
    share = np.array([weight[grades >= k].sum() for k in range(1, top + 1)])
    thresholds = np.log((1 - share) / share)
    weights = np.zeros(n_columns)
    past, past_t = np.full(n_columns, 1e-8), np.full(top, 1e-8)
    for _ in range(ROUNDS):
        scores = np.bincount(rows, values * weights[columns], minlength=n)
        above = _logistic(scores[:, None] - thresholds[None, :])
        # Grade k has the probability edges[k] - edges[k + 1].
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = edges * (1 - edges)
        p = np.maximum(edges[index, grades] - edges[index, grades + 1], 1e-12)
        at, behind = (slope[index, grades + k] / p * weight for k in (0, 1))
        gradient = np.bincount(columns, values * (behind - at)[rows], minlength=n_columns)
        gradient_t = np.bincount(grades, at, minlength=top + 1)[1:]
        gradient_t -= np.bincount(grades, behind, minlength=top + 1)[:top]
        past += gradient**2
        past_t += gradient_t**2
        rate = STEP / np.sqrt(past)
        moved = weights - rate * gradient
        weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0)
        thresholds = np.sort(thresholds - STEP / np.sqrt(past_t) * gradient_t)
    return weights, thresholds


@dataclass
class Sample:
    """Labelled documents as a sparse matrix of feature counts: entry i is ``counts[i]`` at
    (``rows[i]``, ``columns[i]``), and document j stands for ``times[j]`` equal ones. Of all
    labelled documents, ``n_toxic`` and ``n_clean`` are toxic and not, and ``inside`` and
    ``outside`` of those have each feature."""

    features: list[str]
    inside: np.ndarray
    outside: np.ndarray
    n_toxic: int
    n_clean: int
    toxic: np.ndarray
    times: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    counts: np.ndarray

    def marks(self) -> np.ndarray:
        """Which features mark toxic documents."""
        n_in, n_out = max(self.n_toxic, 1), max(self.n_clean, 1)
        often = self.inside / n_in >= MARK_RATIO * (self.outside + 1) / n_out
        words = np.array([not f.startswith(STEM_MARK) for f in self.features], bool)
        return often & words & (self.inside >= MARK_DOCS)

    def grades(self) -> np.ndarray:
        """0 for documents that are not toxic, else 1, or 2 with many marks."""
        marked = np.bincount(
            self.rows, self.counts * self.marks()[self.columns], minlength=len(self.toxic)
        )
        return np.where(self.toxic, 1 + (marked >= SEVERE_MARKS), 0)

    def fit(self) -> OrdinalModel | None:
        """None unless there are two grades or more. Grades that no document has are left
        out; the rest keep their order, and a gap is bridged by the threshold above it."""
        present, grades = np.unique(self.grades(), return_inverse=True)
        if len(present) < 2:
            return None
        weights, thresholds = fit_ordinal(
            self.rows, self.columns, strength(self.counts), grades, len(self.features), self.times
        )
        steps = np.searchsorted(present[1:], np.arange(1, present[-1] + 1))
        used = {f: float(w) for f, w in zip(self.features, weights, strict=True) if w}
        return OrdinalModel(used, thresholds[steps])


def feature_counts(labelled: DataFrame, held: int = HELD) -> DataFrame:
    """``feature`` and the ``inside`` (toxic) and ``outside`` documents that have it, over all
    rows of ``labelled`` (``toxic``, ``text``). Tasks add up their own documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside, inside = seen = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            features = list(outside.keys() | inside.keys())
            return pa.record_batch(
                [
                    pa.array(features, pa.string()),
                    pa.array([inside[f] for f in features], pa.int64()),
                    pa.array([outside[f] for f in features], pa.int64()),
                ],
                names=["feature", "inside", "outside"],
            )

        for batch in batches:
            for toxic, text in zip(*(batch.column(c) for c in ("toxic", "text")), strict=True):
                seen[toxic.as_py()].update(word_counts(text.as_py()).keys())
                if len(outside) + len(inside) > held:
                    yield rows()
                    outside.clear()
                    inside.clear()
        if outside or inside:
            yield rows()

    each = labelled.select("toxic", "text").mapInArrow(
        count, "feature string, inside long, outside long"
    )
    return each.groupBy("feature").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside")
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int
) -> Sample:
    """Features and their counts over all labelled documents, and about ``most`` of these
    documents, those with the smallest hashes, with their features.

    Equal documents of one key are one entry with its number, so a key with any share of all
    rows is no more than that. Words become numbers before anything is collected: first the
    features, bounded by MOST_FEATURES, then each document's entries, bounded by the sample.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg((F.max(label) > 0).alias("toxic"))
    )
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    known = staged(spark, known, "toxicity-labels")
    # Few labels go to the texts; more meet them by key, which takes the texts through a shuffle.
    few = known.count() <= MOST_BROADCAST
    labelled = read.join(F.broadcast(known) if few else known, "key")
    toxic = F.count_if("toxic")
    n_toxic, n_clean = labelled.agg(toxic, F.count("*") - toxic).first()

    apart = F.abs(
        F.col("inside") / max(n_toxic, 1) - F.col("outside") / max(n_clean, 1)
    )
    vocabulary = (
        feature_counts(labelled)
        .where(F.col("inside") + F.col("outside") >= LEAST_DOCS)
        .where(F.col("outside") <= MOST_SHARE * n_clean)
        .orderBy(apart.desc(), "feature")
        .limit(MOST_FEATURES)
    )

    share = most / max(n_toxic + n_clean, most)
    order = row_key(F.col("key"), F.col("text"))
    chosen = F.pmod(F.xxhash64("order"), F.lit(1_000_000)) < int(1_000_000 * share)
    found = labelled.withColumn("order", order).where(chosen).groupBy("order").agg(
        F.any_value("toxic").alias("toxic"),
        F.any_value("text").alias("text"),
        F.count("*").alias("times"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [word_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("order", "toxic", "times")),
                    pa.array([list(w) for w in held], pa.list_(pa.string())),
                    pa.array([list(w.values()) for w in held], pa.list_(pa.int32())),
                ],
                names=["order", "toxic", "times", "features", "counts"],
            )

    schema = "order string, toxic boolean, times long, features array<string>, counts array<int>"
    sample = staged(spark, found.mapInArrow(count, schema), "toxicity-sample")

    table = vocabulary.toArrow().sort_by("feature")
    features = table.column("feature").to_pylist()
    numbers = spark.sparkContext.broadcast({f: at for at, f in enumerate(features)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = numbers.value.get
        for batch in batches:
            at, n = [], []
            held = zip(*(batch.column(c).to_pylist() for c in ("features", "counts")), strict=True)
            for own, counts in held:
                pairs = [(find(f), c) for f, c in zip(own, counts, strict=True) if f in numbers.value]
                at.append([a for a, _ in sorted(pairs)])
                n.append([c for _, c in sorted(pairs)])
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("order", "toxic", "times")),
                    pa.array(at, pa.list_(pa.int32())),
                    pa.array(n, pa.list_(pa.int32())),
                ],
                names=["order", "toxic", "times", "columns", "counts"],
            )

    schema = "order string, toxic boolean, times long, columns array<int>, counts array<int>"
    entries = sample.mapInArrow(number, schema).toArrow().sort_by("order").combine_chunks()
    lengths = pa.compute.list_value_length(entries.column("columns")).to_numpy()
    return Sample(
        features,
        table.column("inside").to_numpy(),
        table.column("outside").to_numpy(),
        n_toxic,
        n_clean,
        entries.column("toxic").to_numpy().astype(bool),
        entries.column("times").to_numpy().astype(float),
        np.repeat(np.arange(len(lengths)), lengths),
        pa.compute.list_flatten(entries.column("columns")).to_numpy().astype(np.int64),
        pa.compute.list_flatten(entries.column("counts")).to_numpy().astype(np.int64),
    )


def grade_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    training_docs: int = TRAINING_DOCS,
) -> DataFrame:
    """``doc`` (the row as a struct), ``severity`` (expected grade, 0 to 2), ``grade`` (the most
    probable) and ``toxic`` (grade 1 or more is likelier than not) for every row of ``docs``.

    The fit reads about ``training_docs`` labelled documents; every text is scored whole.
    A document labelled more than once is toxic if any label says so; labels without a key
    or a value are not used. Null and empty texts have no words and get the severity of such
    a text. Without documents of both kinds nothing can be learned, and severity is 0.
    """
    model = training_sample(docs, labels, key, text, label, training_docs).fit()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            yield _judged(model, [t if isinstance(t, str) else "" for t in texts])

    rows = docs.select(F.struct("*").alias("doc"))
    return rows.withColumn("judged", judge(F.col(f"doc.{text}"))).select("doc", "judged.*")


def _judged(model: OrdinalModel | None, texts: list[str]) -> pd.DataFrame:
    if model is None:
        return pd.DataFrame({"severity": 0.0, "grade": 0, "toxic": False}, index=range(len(texts)))
    scores = np.fromiter(map(model.score, texts), float, len(texts))
    above = model.exceedance(scores)
    edges = np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], axis=1)
    return pd.DataFrame(
        {
            "severity": above.sum(axis=1),
            "grade": (edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype(np.int32),
            "toxic": above[:, 0] > 0.5,
        }
    )
