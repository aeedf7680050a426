"""Which keys a growing table has, so that repeated ones are found without reading it.

A key is held as a 128-bit fingerprint with the number of its rows, in a bucket by that
fingerprint. A slice adds one run of files, partitioned by bucket, and is compared with the
buckets that it has keys in. Runs are merged by levels, so that there are few; a small file,
written last, lists those that count, and nothing that a stopped write leaves is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import named
from tidemark.operators.expectations import any_key
from tidemark.operators.suite import PARTIAL_LIST_SIZE, list_order
from tidemark.shared import child_names, delete_path, read_text, small_frame, write_text

STORED = (
    T.StructType()
    .add("high", "long")
    .add("low", "long")
    .add("rows", "long")
    .add("run", "string")
    .add("bucket", "integer")
)
#: Buckets of an index, runs of a level that become one of the next, and the newest runs that
#: are left alone because their slices may be taken in again.
BUCKETS, FAN, RECENT = 64, 16, 4
KEY = ["bucket", "high", "low"]


def _text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*map(named, columns)), {"ignoreNullFields": "false"})


def _halves(text: Column) -> tuple[Column, Column]:
    """A text's fingerprint in two longs."""
    digest = F.sha2(text, 256)
    part = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return part(1), part(17)


@dataclass
class Run:
    name: str
    level: int


class KeyIndex:
    """The keys of one compound check on one table, below ``path``."""

    def __init__(self, path: str, columns: Sequence[str], buckets: int = BUCKETS, fan: int = FAN):
        self.path, self.columns, self.buckets, self.fan = path, list(columns), buckets, fan

    @property
    def _list(self) -> str:
        return f"{self.path}/runs.json"

    def runs(self, spark: SparkSession) -> list[Run]:
        """The runs that count, oldest first."""
        return [Run(**run) for run in json.loads(read_text(spark, self._list) or "[]")]

    def _write_runs(self, spark: SparkSession, runs: list[Run]) -> None:
        write_text(spark, self._list, json.dumps([vars(run) for run in runs]))

    def _folder(self, name: str) -> str:
        return f"{self.path}/run={name}"

    def _buckets_of(self, spark: SparkSession, name: str) -> list[str]:
        return [n for n in child_names(spark, self._folder(name)) if n.startswith("bucket=")]

    def _read(
        self, spark: SparkSession, runs: list[Run], buckets: set[str] | None = None
    ) -> DataFrame:
        folders = [
            f"{self._folder(run.name)}/{bucket}"
            for run in runs
            for bucket in self._buckets_of(spark, run.name)
            if buckets is None or bucket in buckets
        ]
        if not folders:
            return small_frame(spark, [], STORED)
        return spark.read.schema(STORED).option("basePath", self.path).parquet(*folders)

    def _write(self, keys: DataFrame, name: str) -> None:
        delete_path(keys.sparkSession, self._folder(name))
        files = keys.select("high", "low", "rows", "bucket").repartition("bucket")
        files.write.partitionBy("bucket").parquet(self._folder(name))

    def keys_of(self, rows: DataFrame) -> DataFrame:
        """The keys of ``rows`` with their number of rows and a text; rows without any part of
        the key have none. Equal keys are counted before the shuffle."""
        texts = rows.filter(any_key(self.columns)).select(_text(self.columns).alias("text"))
        counted = texts.groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
        high, low = _halves(F.col("text"))
        return counted.select(
            F.pmod(high, F.lit(self.buckets)).cast("int").alias("bucket"),
            high.alias("high"),
            low.alias("low"),
            "rows",
            "text",
        )

    def add(self, rows: DataFrame, name: str) -> tuple[int, list[str]]:
        """Take in the rows of the slice ``name``, the newest one; again changes nothing.

        Gives by how much the number of rows with a repeated key has grown, and the texts of
        the smallest keys that are repeated and in this slice.
        """
        spark = rows.sparkSession
        before = [run for run in self.runs(spark) if run.name != name]
        own = self.keys_of(rows)
        self._write(own, name)
        grown = self._growth(spark, own, before, set(self._buckets_of(spark, name)))
        self._write_runs(spark, self._merged(spark, [*before, Run(name, 0)]))
        return grown

    def _growth(
        self, spark: SparkSession, own: DataFrame, before: list[Run], buckets: set[str]
    ) -> tuple[int, list[str]]:
        if not buckets:
            return 0, []
        met = own.withColumn("old", F.lit(0).cast("long"))
        if before:
            stored = self._read(spark, before, buckets).groupBy(*KEY)
            stored = stored.agg(F.sum("rows").alias("old"))
            met = own.join(stored, KEY, "left").withColumn("old", F.coalesce("old", F.lit(0)))
        old, total = F.col("old"), F.col("old") + F.col("rows")
        grown = total - F.when(old > 1, old).otherwise(0)
        repeated = met.filter(total > 1).select("text", grown.alias("grown"))
        summed = repeated.agg(F.sum("grown")).first()[0]
        if summed is None:
            return 0, []
        texts = repeated.orderBy("text").limit(PARTIAL_LIST_SIZE).select("text").collect()
        return int(summed), [row[0] for row in texts]

    def _merged(self, spark: SparkSession, runs: list[Run]) -> list[Run]:
        """Runs after merging each level that is full; the list that names them is written by
        the caller, and files that it no longer names go then or with the next merge."""
        level = 0
        while True:
            full = [run for run in runs[:-RECENT] if run.level == level]
            if len(full) < self.fan:
                return runs
            counted = self._read(spark, full).groupBy(*KEY).agg(F.sum("rows").alias("rows"))
            name = f"level{level + 1}-{uuid.uuid4().hex}"
            self._write(counted, name)
            at = runs.index(full[0])
            rest = [run for run in runs if run not in full]
            runs = [*rest[:at], Run(name, level + 1), *rest[at:]]
            self._write_runs(spark, runs)
            for run in full:
                delete_path(spark, self._folder(run.name))
            level += 1

    def repeated(self, spark: SparkSession) -> int:
        """The number of rows with a repeated key, from the whole index."""
        counted = self._read(spark, self.runs(spark)).groupBy(*KEY).agg(F.sum("rows").alias("rows"))
        return counted.filter("rows > 1").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def merged_texts(*lists: Sequence) -> list:
    """The smallest keys of several lists, each once, in the order of reports."""
    distinct = {json.dumps(value): value for own in lists for value in own}
    return sorted(distinct.values(), key=list_order)[:PARTIAL_LIST_SIZE]
