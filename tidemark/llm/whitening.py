"""Whitening of embeddings by an incremental eigendecomposition.

Tasks go over distinct vectors and update a spectrum with each, spectra are merged in a tree,
and the basis that comes out is refined once more on all vectors: their scatter matrix in
that basis is added up by tasks, and its own eigenvectors correct what updates had lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.spectrum import EPS, Spectrum

SCALE, COMPONENTS = 256, 4
#: Numbers from here on have no place in a long once they are multiplied by SCALE.
BEYOND = float(1 << 55)
#: Partial results that one task merges.
FAN_IN = 16
#: Bits of the lower part of a long, which is added up by itself.
LOW_BITS = 24
WHITENED = (
    "struct<deviation: bigint, whitened: array<double>>"
)


def quantised(vector: Column) -> Column:
    """Each entry times SCALE, rounded down to a long; null for a vector that is null or has
    an entry that is null, not finite or too large for that."""
    entry = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < BEYOND)
    fits = vector.isNotNull() & F.forall(vector, entry)
    return F.when(
        F.coalesce(fits, F.lit(False)),
        F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)),
    )


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy().reshape(-1, size)


def _merged(
    parts: DataFrame, merge: Callable[[list[bytes]], bytes], label: str
) -> bytes | None:
    """All rows of ``parts`` (one binary column each) as one, merged by tasks in a tree, so
    that neither a task nor the driver gets more than FAN_IN of them."""
    spark, schema = parts.sparkSession, parts.schema

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                held = [merge([*held, raw])] if held else [raw]
        if held:
            yield pa.record_batch([pa.array(held, pa.binary())], names=schema.names)

    parts = staged(spark, parts, label)
    n = parts.count()
    while n > 1:
        n = -(-n // FAN_IN)
        parts = staged(spark, parts.repartition(n).mapInArrow(some, schema), label)
        n = parts.count()
    row = parts.first()
    return None if row is None else bytes(row[0])


@dataclass
class Whitening:
    """Of ``n`` vectors with per-dimension ``sums``: their principal ``components`` (rows), the
    eigenvalues ``values``, the ``trace`` of the covariance matrix."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def weights(self) -> np.ndarray:
        """Components over the deviation along them; zeros where there is none."""
        least = 8 * self.size * EPS * self.trace
        varied = self.values > least
        scale = np.where(varied, 1 / np.sqrt(np.where(varied, self.values, 1)), 0)
        return self.components * scale[:, None]

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.weights().T

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """Rows less the mean, which loses nothing to the size of the mean."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (rows - whole) - rest

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum) ** 2, exactly; None beyond a long."""
        most = int(np.abs(rows).max(initial=0))
        reach = self.n * most + max(map(abs, self.sums), default=0)
        small = most < 1 << 62 and self.size * reach * reach < 1 << 63
        kind = np.int64 if small else object
        off = rows.astype(kind) * self.n - np.array(self.sums, kind)
        exact = (off * off).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]


def _fit_part(size: int) -> Callable:
    """A task's sums, as low and high parts, and spectrum of its vectors."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, low, high = Spectrum(size), [0] * size, [0] * size
        for batch in batches:
            rows = _matrix(batch.column(0), size)
            low = [a + int(b) for a, b in zip(low, (rows & _LOW).sum(axis=0), strict=True)]
            high = [a + int(b) for a, b in zip(high, (rows >> LOW_BITS).sum(axis=0), strict=True)]
            for row in rows.astype(float):
                spectrum.add(row)
        if spectrum.n:
            sums = [(h << LOW_BITS) + w for h, w in zip(high, low, strict=True)]
            yield pa.record_batch([pa.array([_packed(sums, spectrum)])], names=["part"])

    return fit


_LOW = (1 << LOW_BITS) - 1
_WIDTH = 16


def _packed(sums: list[int], spectrum: Spectrum) -> bytes:
    exact = b"".join(s.to_bytes(_WIDTH, "little", signed=True) for s in sums)
    return exact + spectrum.to_bytes()


def _unpacked(raw: bytes, size: int) -> tuple[list[int], Spectrum]:
    cut = [raw[at : at + _WIDTH] for at in range(0, size * _WIDTH, _WIDTH)]
    sums = [int.from_bytes(part, "little", signed=True) for part in cut]
    return sums, Spectrum.from_bytes(raw[size * _WIDTH :], size)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct ``vectors`` (one column, ``x``: arrays of longs of one
    length, read several times); None without any."""
    first = vectors.first()
    if first is None:
        return None
    size = len(first[0])

    def merge(raw: list[bytes]) -> bytes:
        (sums, spectrum), *others = (_unpacked(part, size) for part in raw)
        for more, other in others:
            sums = [a + b for a, b in zip(sums, more, strict=True)]
            spectrum.merge(other)
        return _packed(sums, spectrum)

    parts = vectors.select("x").mapInArrow(_fit_part(size), "part binary")
    sums, spectrum = _unpacked(_merged(parts, merge, "whitening-spectra"), size)
    rough = Whitening(spectrum.n, sums, np.eye(size), np.ones(size), 1.0)
    basis, _ = np.linalg.qr(spectrum.vectors)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.zeros((size, size))
        seen = 0
        for batch in batches:
            turned = rough.centred(_matrix(batch.column(0), size)) @ basis
            scatter += turned.T @ turned
            seen += batch.num_rows
        if seen:
            yield pa.record_batch([pa.array([scatter.tobytes()], pa.binary())], names=["part"])

    def add(raw: list[bytes]) -> bytes:
        return sum(np.frombuffer(part) for part in raw).tobytes()

    parts = vectors.select("x").mapInArrow(project, "part binary")
    total = np.frombuffer(_merged(parts, add, "whitening-scatter")).reshape(size, size)
    covariance = total / spectrum.n
    values, turn = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(
        spectrum.n,
        sums,
        (basis @ turn[:, order]).T,
        np.maximum(values[order], 0),
        float(np.trace(covariance)),
    )


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """The largest entry of the covariance of the whitened ``vectors``, less the identity, over
    the components that vary; 0 without any."""
    varied = np.flatnonzero(whitening.weights().any(axis=1)).tolist()
    if not varied:
        return 0.0
    white = vectors.select(_judged(whitening, F.col("x"))["whitened"].alias("w"))
    pairs = [(i, j) for i in varied for j in varied if i <= j]
    sums = [F.avg(F.col("w")[i] * F.col("w")[j]) for i, j in pairs]
    sums += [F.avg(F.col("w")[i]) for i in varied]
    found = white.agg(*sums).first()
    mean = dict(zip(varied, found[len(pairs) :], strict=True))
    return max(
        abs(both - mean[i] * mean[j] - (i == j))
        for (i, j), both in zip(pairs, found[: len(pairs)], strict=True)
    )


def _judged(whitening: Whitening, x: Column) -> Column:
    """A struct of a vector's ``deviation`` and ``whitened`` coordinates."""
    shared = whitening

    @F.arrow_udf(WHITENED)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            rows = _matrix(lists, shared.size)
            white = shared.whitened(rows)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(shared.deviations(rows), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                ],
                names=["deviation", "whitened"],
            )

    return judge(x)


def whiten(
    rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``doc`` (the row as a struct) and, for every component from 1 on, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Entries count as whole numbers of 1/SCALE, rounded down. Rows are left out if their vector
    is null or has an entry that is null, not finite or of 2**55 and more, or if its length is
    not the commonest one (the longer of two as common). Every distinct vector counts once in
    the fit, however many rows have it, but all rows are returned. There are no more
    components than dimensions; one along which nothing varies gives ``whitened`` and
    ``explained`` 0. Equal eigenvalues leave their components free to turn. A ``deviation``
    beyond a long is null. Without a vector (empty table, empty vectors) there are no rows.

    An update takes a time that grows with the cube of the dimensions, for each distinct
    vector; a task holds one spectrum and a batch of rows.
    """
    spark = rows.sparkSession
    known = rows.select(F.struct("*").alias("doc"), quantised(F.col(vector)).alias("x"))
    known = known.where("x is not null and size(x) > 0")
    lengths = known.groupBy(F.size("x").alias("length")).count()
    commonest = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    output = "component int, n long, deviation long, whitened double, explained double"
    if commonest is None:
        none = spark.createDataFrame([], f"{output}, identity_error double")
        return known.select("doc").where("false").join(none, F.lit(True), "left")
    known = known.where(F.size("x") == commonest["length"])
    vectors = staged(spark, known.select("x").distinct(), "whitening-vectors")
    whitening = fit(vectors, components)
    error = identity_error(vectors, whitening)
    share = (
        whitening.values / whitening.trace
        if whitening.trace > 0
        else np.zeros(len(whitening.values))
    ) * whitening.weights().any(axis=1)
    explained = F.array(*[F.lit(float(v)) for v in share])
    judged = known.select("doc", _judged(whitening, F.col("x")).alias("judged"))
    return judged.select(
        "doc", "judged.deviation", F.posexplode("judged.whitened").alias("place", "whitened")
    ).select(
        "doc",
        (F.col("place") + 1).alias("component"),
        F.lit(whitening.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
