"""How far the sources of a language differ in the words they use.

A translate table lower-cases letters and blanks everything that separates words in one
pass over a text's bytes; a counter for each document gives the frequencies of its words and
the documents of each. Tasks add both up by language and source, Spark adds up the rest, and
only words that a source has are ever rows: what the others take is known from the totals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: A share of the whole is a whole number of so many parts, and one more.
PARTS = 1_000_000_000
LEAST_DOCS, TOP_TERMS = 3, 200
#: Bytes of a text that are split at a time; words that a task counts before it passes them on.
PIECE, HELD = 1_000_000, 300_000
COUNTS = "lang string, source string, term string, n long, docs long"
GROUP = ["lang", "source"]
TERM = ["lang", "term"]


def _translation() -> bytes:
    """Small letters for A-Z, blanks for every other ASCII byte but letters."""
    table = bytearray(range(256))
    for byte in range(128):
        letter = chr(byte)
        table[byte] = ord(letter.lower()) if letter.isalpha() else ord(" ")
    return bytes(table)


TRANSLATION = _translation()


def document_counts(text: bytes) -> Counter:
    """How often each word is in a text."""
    blanked = text.translate(TRANSLATION)
    if len(blanked) <= PIECE:
        return Counter(blanked.split())
    counts: Counter = Counter()
    start = 0
    while start < len(blanked):
        end = blanked.find(b" ", start + PIECE)
        end = len(blanked) if end < 0 else end
        counts.update(blanked[start:end].split())
        start = end
    return counts


def term_counts(docs: DataFrame) -> DataFrame:
    """COUNTS, several rows for a term at most one for each task's flush; a row with an empty
    term stands for the group itself. ``docs`` has ``lang``, ``source`` and ``text`` as bytes."""

    def rows(held: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (often, in_docs) in held.items():
            size = len(often) + 1
            columns[0] += [lang] * size
            columns[1] += [source] * size
            columns[2] += [b"", *often]
            columns[3] += [0, *often.values()]
            columns[4] += [0, *map(in_docs.__getitem__, often)]
        lang, source, term, n, in_docs = columns
        terms = pa.array(term, pa.binary()).cast(pa.string())
        longs = pa.array(n, pa.int64()), pa.array(in_docs, pa.int64())
        names = ["lang", "source", "term", "n", "docs"]
        return pa.record_batch([pa.array(lang), pa.array(source), terms, *longs], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
                often, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(often)
                found = document_counts(text.as_py())
                often.update(found)
                in_docs.update(found.keys())
                size += len(often) - before + 1
                if size > HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return docs.mapInArrow(count, COUNTS)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """A term's parts of PARTS, with one occurrence more than there are; exact for any counts."""
    over = (n + 1).cast("decimal(20,0)") * F.lit(PARTS).cast("decimal(10,0)")
    under = F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)")
    return 1 + F.call_function("div", over, under)


def _excess(p: Column, q: Column) -> Column:
    """(p-q)^2 / q, rounded down; p and q are below 2^30 + 2."""
    return F.call_function("div", (p - q) * (p - q), q)


def _exact_sum(value: Column) -> Column:
    return F.sum(value.cast("decimal(38,0)")).cast("long")


def _common_terms(shares: DataFrame) -> DataFrame:
    """For every two sources that have a term in common, what counting these terms as common
    adds to the divergence: ``lang``, ``source``, ``other``, ``value``, several rows each."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}
        rest: pa.Table | None = None

        def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            return (p - q) ** 2 // q

        def both(some: pa.Table) -> None:
            lang, term = (some.column(c).combine_chunks().dictionary_encode() for c in TERM)
            new = np.ones(some.num_rows, bool)
            new[1:] = (np.diff(lang.indices.to_numpy()) != 0) | (
                np.diff(term.indices.to_numpy()) != 0
            )
            run = np.cumsum(new)
            longest = int(np.bincount(run).max())
            source = some.column("source").combine_chunks().dictionary_encode()
            names, of = source.dictionary.to_pylist(), source.indices.to_numpy().astype(np.int64)
            langs, of_lang = lang.dictionary.to_pylist(), lang.indices.to_numpy().astype(np.int64)
            p, none = (some.column(c).to_numpy() for c in ("p", "none"))
            for apart in range(1, longest):
                at = np.flatnonzero(run[apart:] == run[:-apart])
                for a, b in ((at, at + apart), (at + apart, at)):
                    value = (
                        excess(p[a], p[b]) - excess(p[a], none[b])
                        - excess(none[a], p[b]) + excess(none[a], none[b])
                    )
                    pair = (of_lang[a] * len(names) + of[a]) * len(names) + of[b]
                    order = np.argsort(pair, kind="stable")
                    pairs, first = np.unique(pair[order], return_index=True)
                    totals = np.add.reduceat(value[order], first) if len(first) else value
                    for number, total in zip(pairs.tolist(), totals.tolist(), strict=True):
                        number, to = divmod(number, len(names))
                        number, one = divmod(number, len(names))
                        key = langs[number], names[one], names[to]
                        sums[key] = sums.get(key, 0) + total

        for batch in batches:
            some = pa.Table.from_batches([batch])
            if rest is not None:
                some = pa.concat_tables([rest, some])
            last = [some.column(c)[-1].as_py() for c in TERM]
            start = some.num_rows  # the last term may go on in the next batch
            while start and [some.column(c)[start - 1].as_py() for c in TERM] == last:
                start -= 1
            if start:
                both(some.slice(0, start))
            rest = some.slice(start)
        if rest is not None:
            both(rest)
        if sums:
            keys = list(zip(*sums, strict=True))
            yield pa.record_batch(
                [*map(pa.array, keys), pa.array(sums.values(), pa.int64())],
                names=["lang", "source", "other", "value"],
            )

    ordered = (
        shares.select(*TERM, "source", "p", "none")
        .repartition(*TERM)
        .sortWithinPartitions(*TERM, "source")
    )
    return ordered.mapInArrow(add_up, "lang string, source string, other string, value long")


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every source of every
    language.

    Of a language's terms (runs of letters and characters beyond ASCII, A-Z lower-cased) those
    in at least ``least_docs`` of its documents count. Part ``pair``: how far each other source
    of the language is off, summed over those terms. Part ``term``: the ``top`` terms that the
    source has more often than its language. Ties go to the item that sorts first. All
    arithmetic is exact.

    Nulls are empty strings. Repeated rows count as documents of their own. A source without
    terms, also one with empty texts only, has pairs and no term; an empty table gives no rows.
    Other columns are not read. Texts are counted whole, whatever their length; a task holds
    HELD counts and passes them on, so no source and no term is one task's work.
    """
    spark = docs.sparkSession
    texts = docs.select(
        *[
            F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
            for name, column in (("lang", lang), ("source", source), ("text", text))
        ]
    ).withColumn("text", F.col("text").cast("binary"))
    by_source = (
        term_counts(texts)
        .repartition(*TERM)
        .groupBy(*TERM, "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    of_term = Window.partitionBy(*TERM)  # a row for each source
    counts = staged(
        spark,
        by_source.select(
            *TERM,
            "source",
            "n",
            F.sum("n").over(of_term).alias("lang_n"),
            F.sum("docs").over(of_term).alias("lang_docs"),
            (F.min("source").over(of_term) == F.col("source")).alias("first"),
        ),
        "divergence-counts",
    )
    kept = counts.where((F.col("term") != "") & (F.col("lang_docs") >= least_docs))
    languages = kept.groupBy("lang").agg(
        F.count_if("first").alias("terms"), F.sum("n").alias("lang_total")
    )
    sizes = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    none = {"terms": 0, "lang_total": 0, "total": 0, "own": 0}
    groups = (
        counts.where("term = ''")
        .select(*GROUP)
        .join(languages, "lang", "left")
        .join(sizes, GROUP, "left")
        .fillna(none)
        .withColumn("none", _share(F.lit(0), F.col("total"), F.col("terms")))
    )
    groups = staged(spark, groups, "divergence-groups")
    shares = kept.join(groups, GROUP).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("terms"))
    )
    parts = _terms(shares, top).unionByName(_pairs(shares, groups))
    return parts.select(*GROUP, "part", "item", "value", "rank")


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The first ``top`` terms of each source; tasks leave out what cannot be among them."""
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = shares.withColumn("q", q).where("p > q")
    first = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    return (
        more.select(
            *GROUP,
            F.lit("term").alias("part"),
            F.col("term").alias("item"),
            _excess(F.col("p"), F.col("q")).alias("value"),
        )
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= top)
    )


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of each source's language.

    As if no term were in both sources, a source's terms meet what the other takes for a term
    that it does not have, which depends on their counts alone: one row for each count. What
    terms in both change is added to that.
    """
    others = groups.select(
        "lang", F.col("source").alias("other"), F.col("none").alias("other_none"),
        F.col("own").alias("other_own"),
    )
    counted = shares.groupBy(*GROUP, "p").agg(F.count("*").alias("times"))
    met = counted.join(others, "lang").where("source != other")

    def total(value: Column) -> Column:
        times = F.col("times").cast("decimal(19,0)")
        return F.sum(times * value.cast("decimal(19,0)")).cast("long")

    alone = staged(
        groups.sparkSession,
        met.groupBy(*GROUP, "other").agg(
            total(_excess(F.col("p"), F.col("other_none"))).alias("out"),
            total(_excess(F.col("other_none"), F.col("p"))).alias("back"),
        ),
        "divergence-alone",
    )
    there = alone.select(*GROUP, "other", "out")
    back = alone.select(
        "lang", F.col("source").alias("other"), F.col("other").alias("source"), "back"
    )
    common = _common_terms(shares).groupBy(*GROUP, "other").agg(
        _exact_sum(F.col("value")).alias("common")
    )
    pair = [*GROUP, "other"]
    joined = (
        groups.join(others, "lang")
        .where("source != other")
        .join(there, pair, "left")
        .join(back, pair, "left")
        .join(common, pair, "left")
        .fillna({"out": 0, "back": 0, "common": 0})
    )
    neither = (F.col("terms") - F.col("own") - F.col("other_own")) * _excess(
        F.col("none"), F.col("other_none")
    )
    value = F.col("out") + F.col("back") + F.col("common") + neither
    ordered = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    return joined.select(
        *GROUP, F.lit("pair").alias("part"), F.col("other").alias("item"), value.alias("value")
    ).withColumn("rank", F.row_number().over(ordered))
