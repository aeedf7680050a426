"""Folders into which somebody else lands files, and which of them are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``length`` and ``modified`` of the files below a folder, also in partition
    folders. The files are listed, not opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def new_files(landed: DataFrame, known: DataFrame, most: int | None = None) -> DataFrame:
    """The landed files that are not ``known`` by their path, the oldest ``most`` of them; what
    is left over is still new the next time."""
    fresh = landed.join(known.select("path"), "path", "left_anti")
    return fresh if most is None else fresh.orderBy("modified", "path").limit(most)


def read_files(spark: SparkSession, files: DataFrame, base: str) -> DataFrame:
    """``(city, payload)`` rows of some files below ``base``/city=<name>/."""
    literal = F.regexp_replace("path", r"([\\\[\]{}*?])", r"\\$1")  # a path is no pattern
    paths = [row[0] for row in files.select(literal).collect()]
    reader = spark.read.schema("payload string, city string").option("basePath", base)
    if not paths:
        return spark.createDataFrame([], "city string, payload string")
    return reader.text(paths).select("city", "payload")
