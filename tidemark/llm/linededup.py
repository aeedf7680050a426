"""Line deduplication over levelled sorted runs of line hashes.

The hashes of the lines seen so far live in runs: sorted tables of (hash, documents
that hold it, largest of their keys). A batch is anti-joined with them: hashes that no run
holds are new and make a run of keys, the others a run of updates, which say how many more
documents hold them and the largest key among those. So each hash is in one run of keys, and
updates are as few as lines that batches share. When a level holds ``fanout`` runs, they are
compacted into one run of the next level, so n batches leave O(fanout * log n) runs and each
hash is rewritten O(log n) times. A small file lists the runs that count and is written last:
a later session goes on with the same runs, and what a stopped write leaves is not read.
"""

from __future__ import annotations

import json
import uuid
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACES, ascii_lower, row_key, scratch, staged
from tidemark.shared import delete_path, read_text, write_text

RUN_KEY = ["h1", "h2"]
#: A null document key counts as smaller than any other.
SMALLEST = -(2**63)
SECOND = 7


def lines_of(text: Column) -> Column:
    """A text's lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> tuple[Column, Column]:
    """128 bits in two seeds: even 10**12 lines share no hash by chance."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(SECOND), key).alias("h2")


def line_table(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """What the runs need of each row of ``docs``, without its text: ``row`` (a hash of key and
    text), ``rank`` (of its key), the hashes of its long lines by place (``places``) and of its
    different long lines (``hashes``)."""
    read = docs.select(
        row_key(F.col(key), F.col(text)).alias("row"),
        _rank(F.col(key)).alias("rank"),
        F.transform(
            lines_of(F.col(text)),
            lambda line, at: F.struct(at.alias("at"), line_key(line).alias("line")),
        ).alias("lines"),
    )
    kept = read.select(
        "row",
        "rank",
        F.filter("lines", lambda k: F.length(k["line"]) >= least_chars).alias("lines"),
    )
    return kept.select(
        "row",
        "rank",
        F.transform(
            "lines", lambda k: F.struct(k["at"].alias("at"), *_hashes(k["line"]))
        ).alias("places"),
        F.transform(
            F.array_distinct(F.transform("lines", lambda k: k["line"])),
            lambda line: F.struct(*_hashes(line)),
        ).alias("hashes"),
    )


def _rank(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(SMALLEST))


KEYS, UPDATES = "keys", "updates"
RUN = "h1 long, h2 long, n_docs long, last_doc long"


class LineRuns:
    """The runs of one corpus below ``root`` (or a new folder), as they were left there. Batches
    are rows of :func:`line_table`."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.root = root or scratch(spark, "line-runs")
        listed = json.loads(read_text(spark, f"{self.root}/runs.json") or "{}")
        #: By kind, the names of the runs of each level.
        self.levels: dict[str, list[list[str]]] = listed or {KEYS: [], UPDATES: []}

    def run_of(self, batch: DataFrame) -> DataFrame:
        """The run of a batch: a document counts once for each of its different lines."""
        return (
            batch.select("rank", F.explode("hashes").alias("hash"))
            .select("rank", "hash.h1", "hash.h2")
            .groupBy(*RUN_KEY)
            .agg(F.count("*").alias("n_docs"), F.max("rank").alias("last_doc"))
        )

    def add(self, batch: DataFrame) -> None:
        """Takes a batch in: what no run holds as keys, the rest as updates."""
        own = self._written(self.run_of(batch))
        run = self._read([own])
        fresh = self._written(self.fresh(run))
        known = self._written(run.join(self._keys(), RUN_KEY, "left_semi"))
        old = [own]
        for kind, name in ((KEYS, fresh), (UPDATES, known)):
            levels = self.levels[kind]
            levels[:] = levels or [[]]
            levels[0].append(name)
            old += self._compacted(kind)
        self._list()
        for name in old:
            delete_path(self.spark, f"{self.root}/{name}")

    def fresh(self, run: DataFrame) -> DataFrame:
        """The hashes of a batch's run that no run holds yet: the merge-anti-join."""
        return run.join(self._keys(), RUN_KEY, "left_anti")

    def merged(self) -> DataFrame:
        """All runs as one: of each hash the documents and the largest key."""
        return self._merge([n for kind in self.levels for n in self._names(kind)])

    def _names(self, kind: str) -> list[str]:
        return [name for level in self.levels[kind] for name in level]

    def _keys(self) -> DataFrame:
        return self._read(self._names(KEYS)).select(*RUN_KEY)

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*[f"{self.root}/{name}" for name in names])

    def _merge(self, names: list[str]) -> DataFrame:
        runs = self._read(names).groupBy(*RUN_KEY)
        return runs.agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def _written(self, run: DataFrame) -> str:
        name = f"run-{uuid.uuid4().hex}"
        run.sortWithinPartitions(*RUN_KEY).write.parquet(f"{self.root}/{name}")
        return name

    def _compacted(self, kind: str) -> list[str]:
        """Merges every level that is full into one run of the next; the runs that go."""
        levels, old, level = self.levels[kind], [], 0
        while level < len(levels):
            if len(levels[level]) >= self.fanout:
                # Runs of keys share no hash: put together, they need no adding up.
                whole = self._read(levels[level]) if kind == KEYS else self._merge(levels[level])
                if level + 1 == len(levels):
                    levels.append([])
                levels[level + 1].append(self._written(whole))
                old += levels[level]
                levels[level] = []
            level += 1
        return old

    def _list(self) -> None:
        write_text(self.spark, f"{self.root}/runs.json", json.dumps(self.levels))

    def repeated(self, batch: DataFrame, least_docs: int) -> DataFrame:
        """The places (``drops``) of the lines of each ``row`` of a batch that ``least_docs``
        documents hold, a larger key among them: the anti-join of the batch with the runs.

        Only places and hashes are shuffled. A line may be in any share of the documents: the
        few repeated hashes are broadcast if they are small, else Spark splits the batch.
        """
        held = self.merged().where(F.col("n_docs") >= least_docs).drop("n_docs")
        held = staged(self.spark, held, "line-repeated")
        places = batch.select("row", "rank", F.explode("places").alias("place"))
        return (
            places.select("row", "rank", "place.at", "place.h1", "place.h2")
            .join(held, RUN_KEY)
            .where("rank < last_doc")
            .groupBy("row")
            .agg(F.collect_set("at").alias("drops"))
        )


def without_lines(docs: DataFrame, drops: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` less the lines at the places ``drops`` has for their ``row``: ``doc`` (the row
    as a struct), ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays)."""
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        row_key(F.col(f"doc.{key}"), F.col(f"doc.{text}")).alias("row"),
        lines_of(F.col(f"doc.{text}")).alias("lines"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    fewer = F.transform(places, lambda at: F.get("lines", at))
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(fewer)
    return rows.join(drops, "row", "left").select(
        "doc",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_docs: int = 3,
    least_chars: int = 20,
    batches: int = 4,
    fanout: int = 3,
) -> DataFrame:
    """Drops lines repeated across ``docs``, which enter the runs in ``batches``.

    A line's key is the line without white space at its ends, A-Z lower-cased; keys of
    at least ``least_chars`` code points in at least ``least_docs`` rows lose all their
    lines but those of the largest document key. Returns what :func:`without_lines` does.
    Texts are read twice, to hash their lines and to drop them.

    Rows count as documents, repeated rows too; rows that share the largest key all keep
    their lines. Null and empty texts are one empty line and keep it. A null key is the
    smallest; keys are integers. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch(spark, "line-table")
    table = line_table(docs, key, text, least_chars)
    number = F.pmod(F.xxhash64("rank"), F.lit(batches)).cast("int").alias("batch")
    table.select("*", number).write.partitionBy("batch").parquet(path)
    stored = T.StructType([*table.schema.fields, T.StructField("batch", T.IntegerType())])
    table = spark.read.schema(stored).parquet(path)
    runs = LineRuns(spark, fanout=fanout)
    for batch in range(batches):  # each is a folder of its own, the others are not read
        runs.add(table.where(F.col("batch") == batch))
    drops = staged(spark, runs.repeated(table, least_docs), "line-drops")
    return without_lines(docs, drops, key, text)
