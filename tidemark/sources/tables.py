"""Path-addressed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import is_complete


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write of the table has ended: chooses between initial and incremental load.

    A folder that a first write is still filling, or has left half-written, is no table.
    """
    return is_complete(spark, path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def append_partitioned(
    rows: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("year", "month"),
    fmt: str = "parquet",
) -> None:
    """Append below ``path/<partition>=<value>/``.

    The rebalance hint spreads rows evenly over tasks of a fair size, so a batch adds few
    files and a month with most of the rows is not one task's work.
    """
    (
        rows.hint("rebalance")
        .write.format(fmt)
        .partitionBy(*partition_by)
        .mode("append")
        .save(path)
    )


def latest_first(silver: DataFrame, rows: int | None) -> DataFrame:
    """The display order of the silver table: city ascending, hour descending; the first
    ``rows`` of it, or all for None."""
    ordered = silver.orderBy(F.asc("city"), F.desc("hour_start"))
    return ordered if rows is None else ordered.limit(rows)
