"""Whitening against one eigendecomposition of all vectors, and updates against numpy."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.spectrum import Spectrum
from tidemark.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, component int, n string, doc string"


def frame(spark, vectors):
    rows = [(n, v, 7, "n", "d") for n, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def usable(vector):
    return bool(vector) and all(v is not None and math.isfinite(v) for v in vector)


def check(spark, vectors, parts=4):
    got = whiten(frame(spark, vectors).repartition(parts)).orderBy("doc.vec_id", "component").collect()
    kept = {n: v for n, v in enumerate(vectors) if usable(v)}
    x = {n: [math.floor(256 * float(np.float32(c))) for c in v] for n, v in kept.items()}
    distinct = sorted(set(map(tuple, x.values())))
    n, size = len(distinct), len(distinct[0])
    sums = [sum(column) for column in zip(*distinct, strict=True)]
    matrix = np.array(distinct, float)
    matrix = matrix - matrix.mean(axis=0)
    values, vectors = np.linalg.eigh(matrix.T @ matrix / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    wanted = min(4, size)
    assert [(r.doc.vec_id, r.component) for r in got] == [
        (k, c) for k in sorted(kept) for c in range(1, wanted + 1)
    ]
    for r in got:
        assert r.n == n
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.doc.vec_id], sums, strict=True))
        share = values[r.component - 1] / max(values.sum(), 1e-300)
        assert r.explained == pytest.approx(share, rel=1e-9, abs=1e-14)
        assert r.identity_error < 1e-9
    for c in range(wanted):
        own = np.array([r.whitened for r in got if r.component == c + 1])
        if values[c] <= 1e-9 * max(values.sum(), 1e-300):
            assert not own.any()
            continue
        apart = values[c] - np.delete(values, c)
        if np.abs(apart).min(initial=np.inf) < 1e-6 * values[0]:
            continue  # equal eigenvalues: any turn will do
        rows = np.array([x[k] for k in sorted(kept)], float) - np.array(sums) / n
        want = rows @ vectors[:, c] / math.sqrt(values[c])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8
    return got


def test_given_embeddings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(spark, [r.embedding for r in rows])


def test_nulls_non_finite_entries_and_repeated_rows(spark):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, v)) for v in rng.normal(size=(60, 5))]
    vectors += vectors[:20] * 3 + [vectors[0]] * 50
    vectors += [None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0]]
    check(spark, vectors)


@pytest.mark.parametrize(
    "vectors",
    [
        [[1.5, 2.0, -3.0]],
        [[1.0, 1.0], [1.0, 1.0]],
        [[0.0, 1.0, 2.0, 3.0, 4.0], [1.0, 0.0, 2.0, 3.0, 4.0], [0.5, 0.25, 2.0, 3.0, 4.5]],
        [[-0.0], [0.001], [3.25], [-0.001]],
        [[float(i == j) for j in range(6)] for i in range(6)],
        [[float(a), float(a), float(b)] for a in range(4) for b in range(3)],
    ],
)
def test_few_vectors_little_variance_and_equal_eigenvalues(spark, vectors):
    check(spark, vectors, parts=2)


def test_many_partial_results_are_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    check(spark, [list(map(float, v)) for v in rng.normal(size=(90, 4))], parts=9)


def test_other_lengths_and_numbers_beyond_a_long_are_left_out(spark):
    vectors = [[1.0, 2.0], [3.0, 5.0], [1.0], [], [1.0, 2.0, 3.0], [1e30, 0.0]]
    got = whiten(frame(spark, vectors)).collect()
    assert {r.doc.vec_id for r in got} == {0, 1}


def test_a_deviation_beyond_a_long_is_null(spark):
    got = whiten(frame(spark, [[2.0**40, 1.0], [-(2.0**40), 3.0], [5.0, 5.0]])).collect()
    assert {r.deviation for r in got if r.doc.vec_id < 2} == {None}
    assert {r.doc.vec_id for r in got} == {0, 1, 2}


def test_without_vectors(spark):
    for vectors in ([], [None], [[]]):
        out = whiten(frame(spark, vectors))
        assert out.count() == 0
        assert out.columns[:3] == ["doc", "component", "n"]


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_updates_follow_the_scatter_matrix(size):
    rng = np.random.default_rng(size)
    rows = rng.integers(-4, 5, (150, size)).astype(float)
    rows[50:80] = rows[:30]
    one, two = Spectrum(size), Spectrum(size)
    for row in rows[:70]:
        one.add(row)
    for row in rows[70:]:
        two.add(row)
    one.merge(Spectrum(size))
    one.merge(Spectrum.from_bytes(two.to_bytes(), size))
    off = rows - rows.mean(axis=0)
    scatter = off.T @ off
    scale = np.abs(scatter).max()
    assert one.n == 150 and np.allclose(one.mean, rows.mean(axis=0))
    assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-12
    assert np.abs((one.vectors * one.values) @ one.vectors.T - scatter).max() < 1e-11 * scale
