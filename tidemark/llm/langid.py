"""Language identification with one Kneser-Ney character model per language.

Counts of grams cover all training texts: tasks count, Spark adds up and makes the models,
which keep every gram and are read in blocks that a task can hold. A text gets the language
in whose model it takes the fewest bits per symbol. It is rejected if even those are more than a stated
share of that language's own texts of its length take: texts that the models have not
learned from, kept back to calibrate the bounds.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.charmodel import text_grams
from tidemark.llm.charstore import StoredModels, store_models
from tidemark.llm.common import enter, small_batches, staged
from tidemark.shared import small_frame

UNDETERMINED = "und"
#: The share of a language's own texts that its bound lets pass, and the calibrating texts
#: that it takes to read such a share off their distribution.
QUANTILE, ENOUGH = 0.999, 1000
#: Fewer calibrating texts of a language, or of all, say nothing.
LEAST = 5
#: Median of the square of a normal distance.
HALF = 0.455
#: A score is a probability as if a text had no more symbols than this.
SCORED_SYMBOLS = 50
#: Grams, of all languages together, that a task gathers before it passes them on.
FLUSH = 2_000_000


def held_out(key: Column) -> Column:
    """Whether a document is kept from training; those without a key are not."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def calibrating(key: Column) -> Column:
    """Whether a document calibrates the bounds instead of being learned: one in ten of all.
    Its checksum is odd, so it is never one that is held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 10 == 3, F.lit(False))


def gram_counts(texts: DataFrame, most: int = FLUSH) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all rows of ``texts`` (lang, text; no nulls). A task holds
    about ``most`` grams, however many languages they are of."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[starts], np.add.reduceat(np.concatenate([n for _, n in parts])[order], starts)

    def rows(lang: str, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        langs = pa.DictionaryArray.from_arrays(np.zeros(len(keys), np.int32), [lang])
        return pa.record_batch(
            [langs.cast(pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
            names=["lang", "gram", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("langid")
        seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names, of_name = np.unique(langs, return_inverse=True)
            for found, of in text_grams(texts):
                spoken = of_name[of]
                for number in np.unique(spoken).tolist():
                    keys, n = np.unique(found[spoken == number], return_counts=True)
                    seen.setdefault(str(names[number]), []).append((keys, n.astype(np.int64)))
                    held += len(keys)
                if held > most:
                    seen = {lang: [merged(parts)] for lang, parts in seen.items()}
                    held = sum(len(parts[0][0]) for parts in seen.values())
                if held > most // 2 and all(len(parts) == 1 for parts in seen.values()):
                    for lang, parts in seen.items():
                        yield rows(lang, *parts[0])
                    seen, held = {}, 0
        for lang, parts in seen.items():
            yield rows(lang, *merged(parts))

    partial = texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> StoredModels | None:
    """Models from the rows of ``docs`` with a text and a language, and bounds from those of
    them that are :func:`calibrating`; None without any. Languages of which all texts are
    calibrating are learned from those."""
    spark = docs.sparkSession
    small_batches(spark)
    usable = docs.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), calibrating(F.col(key)).alias("apart")
    ).where("lang is not null and text is not null")
    apart = usable.where("apart")
    counts = staged(spark, gram_counts(usable.where("not apart")), "langid-counts")
    learned = {r[0] for r in counts.select("lang").distinct().collect()}
    others = {r[0] for r in apart.select("lang").distinct().collect()} - learned
    if others:
        more = gram_counts(apart.where(F.col("lang").isin(*others)))
        counts = staged(spark, counts.unionByName(more), "langid-counts")
        apart = apart.where(~F.col("lang").isin(*others))
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    root, usual = store_models(counts)
    found = {r["lang"]: r for r in usual.collect()}
    mean = np.array([found[lang]["mean"] for lang in languages])
    deviation = np.array([found[lang]["deviation"] for lang in languages])
    return calibrated(StoredModels(languages, root, mean, deviation), apart)


def calibrated(models: StoredModels, texts: DataFrame) -> StoredModels:
    """``models`` with their bounds, from ``texts`` (lang, text) that they did not learn.

    Bits per symbol vary between a language's texts, and by chance the more the shorter a
    text is: a bound is a reach in units of that spread and a slack in bits. With ENOUGH texts
    of a language, or else of all, the reach is what a normal distribution needs and the slack
    the QUANTILE of what texts take beyond it. With fewer, the reach holds for every
    distribution with their mean square (Cantelli's inequality). Only texts that are given
    their own language count, as wrong labels would widen it.
    """
    spark, languages = texts.sparkSession, models.languages
    shared = spark.sparkContext.broadcast(models)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("langid")
        models = shared.value
        for batch in batches:
            bits, sizes = models.entropies(batch.column(1).to_pylist())
            best = np.array(models.languages, object)[bits.argmin(axis=1)]
            yield pa.record_batch(
                [batch.column(0), pa.array(best, pa.string()), pa.array(bits.min(axis=1)), pa.array(sizes)],
                names=["lang", "lang_pred", "bits", "size"],
            )

    # A UDF whose result is filtered by and kept is run twice, each time by a worker of its own.
    schema = "lang string, lang_pred string, bits double, size long"
    own = texts.select("lang", "text").mapInArrow(read, schema)
    own = own.where("size > 0 and lang = lang_pred").drop("lang_pred")
    own = staged(spark, own, "langid-calibration")

    def described(**values: np.ndarray) -> DataFrame:
        schema = "lang string, " + ", ".join(f"{name} double" for name in values)
        rows = zip(languages, *[v.tolist() for v in values.values()], strict=True)
        return own.join(small_frame(spark, rows, T._parse_datatype_string(schema)), "lang")

    def by_language(frame: DataFrame, *measures: Column) -> tuple[np.ndarray, np.ndarray]:
        """A row of the count and ``measures`` for each language, and one for all together."""
        found = frame.rollup("lang").agg(F.count("*"), *measures).collect()
        found = {r[0]: [np.nan if v is None else v for v in r[1:]] for r in found}
        none = [0] + [np.nan] * len(measures)
        return np.array([found.get(lang, none) for lang in languages]), np.array(found.get(None, none))

    off, chance = F.col("bits") - F.col("usual"), F.col("within") / F.col("size")
    median = F.percentile_approx(off, 0.5, 100_000)
    each, whole = by_language(described(usual=models.mean), median)
    if whole[0] < LEAST:
        same = np.ones(len(languages))
        return dataclasses.replace(
            models, usual=models.mean, between=same, reach=same * np.inf, slack=same
        )
    usual = models.mean + np.where(each[:, 0] < LEAST, whole[1], each[:, 1])
    within = models.deviation**2
    excess = F.percentile_approx(off * off / HALF, 0.5, 100_000) - F.percentile_approx(
        chance, 0.5, 100_000
    )
    each, whole = by_language(described(usual=usual, within=within), excess)
    between = np.maximum(np.where(each[:, 0] < LEAST, whole[1], each[:, 1]), 0)
    spread = F.sqrt(F.col("between") + chance)
    normal = NormalDist().inv_cdf(QUANTILE)
    each, whole = by_language(
        described(usual=usual, within=within, between=between),
        F.percentile_approx(off - normal * spread, QUANTILE, 100_000),
        F.sqrt(F.avg((off / spread) ** 2)) * math.sqrt(QUANTILE / (1 - QUANTILE)),
    )
    if whole[0] >= ENOUGH:
        slack = np.maximum(np.where(each[:, 0] >= ENOUGH, each[:, 1], whole[1]), 0)
        reach = np.full(len(languages), normal)
    else:
        slack, reach = np.zeros(len(languages)), np.full(len(languages), whole[2])
    return dataclasses.replace(models, usual=usual, between=between, reach=reach, slack=slack)


def identify(
    docs: DataFrame, models: StoredModels | None, text: str = "text"
) -> DataFrame:
    """``doc`` (the row as a struct), ``lang_pred``, ``score`` (0 to 1), ``bits`` (per symbol)
    and ``rejected``, for every row of ``docs``.

    Null texts and texts without a letter are ``und``, score 0, rejected. Ties go to the
    language that sorts first. A text with a letter is always given a language, rejected or
    not; without any model everything is ``und``, and with too few texts to calibrate the bounds
    no text with a letter is rejected. Texts of any length are read whole.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, bits double, rejected boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enter("langid")
        models = shared.value
        for texts in batches:
            yield _judged(models, [t if isinstance(t, str) else "" for t in texts])

    rows = docs.select(F.struct("*").alias("doc"))
    return rows.withColumn("judged", judge(F.col(f"doc.{text}"))).select("doc", "judged.*")


def _judged(models: StoredModels | None, texts: list[str]) -> pd.DataFrame:
    none = pd.DataFrame(
        {"lang_pred": UNDETERMINED, "score": 0.0, "bits": None, "rejected": True},
        index=range(len(texts)),
    ).astype({"bits": float})
    if models is None or not len(texts):
        return none
    bits, sizes = models.entropies(texts)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(texts)), best]
    weight = np.minimum(sizes, SCORED_SYMBOLS)[:, None]
    score = 1 / np.exp2(-(bits - least[:, None]) * weight).sum(axis=1)
    rejected = least > models.bound(best, sizes)
    judged = pd.DataFrame(
        {
            "lang_pred": np.array(models.languages, object)[best],
            "score": score,
            "bits": least,
            "rejected": rejected,
        }
    )
    return judged.where(pd.Series(sizes > 0), none)


def language_id(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """:func:`identify` for ``docs``, learned from those of them that are not held out."""
    models = train(docs.where(~held_out(F.col(key))), text, lang, key)
    return identify(docs, models, text)
