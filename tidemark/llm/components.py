"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step on ``links`` (a > b): each node's neighbours (the larger ones, or the smaller
    ones and itself) are linked to the smallest node around it."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near, joined = both, F.col("b") > F.col("a")
    else:
        near, joined = links, F.lit(True)
    least = near.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("of"), F.least("a", "least").alias("least"))
    met = near.join(least, near["a"] == F.col("of")).where(joined)
    moved = met.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("of").alias("a"), F.col("least").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component, ``root``, for every node of ``links``
    (a, b: integers) but the roots themselves.

    Nothing is collected but a count and a check sum per round; every round is written to
    the shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    spark = links.sparkSession
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = staged(spark, ordered.where("a > b").distinct(), "components")
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        current = staged(spark, _stars(_stars(current, large=True), large=False), "components")
