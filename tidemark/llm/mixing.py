"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed place in [0, 2**60): a hash of its key and text. A
source's remaining budget becomes a threshold on that place. It is found from
histograms of words by hash bucket: the first covers the whole range, each
further one only the bucket in which a budget ends. Documents are never sorted.
A larger budget has a higher threshold on the same places, so budgets are
nested: raising one only adds documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, staged, word_count

HASH_BITS = 60
BUCKET_BITS = 10


def place(key: Column, text: Column) -> Column:
    """A document's place: the first 60 bits of a hash of key and text."""
    return F.conv(F.substring(row_key(key, text), 1, HASH_BITS // 4), 16, 10).cast("long")


def allot(sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Targets of ``sources`` (source, source_size): adds ``target``.

    Sources in order of their name, null last, take ``weights`` in turn and divide
    ``share`` of all words. No target passes ``repeats`` times its source; what is
    cut there goes to the others by weight. Sources fill in the order of their
    limit per weight, so the level at which the rest stands follows from running
    sums. One row per source passes through one task.
    """
    everything = Window.partitionBy(F.lit(0))
    named = everything.orderBy(F.col("source").asc_nulls_last())
    filling = everything.orderBy("limit_per_weight", "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sources.withColumn("rank", F.row_number().over(named))
    weighed = ranked.select(
        "source",
        "source_size",
        "rank",
        F.element_at(
            F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")
        ).alias("weight"),
        (F.col("source_size") * repeats).alias("limit"),
    ).withColumn("limit_per_weight", F.col("limit") / F.col("weight"))
    levels = weighed.select(
        "*",
        F.row_number().over(filling).alias("turn"),
        (
            (
                F.sum("source_size").over(everything) * F.lit(float(share))
                - F.coalesce(F.sum("limit").over(before), F.lit(0))
            )
            / (
                F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0))
            )
        ).alias("level"),
    )
    open_turn = F.when(
        F.col("level") * F.col("weight") < F.col("limit"), F.struct("turn", "level")
    )
    found = levels.withColumn("first_open", F.min(open_turn).over(everything))
    full = F.col("first_open").isNull() | (F.col("turn") < F.col("first_open.turn"))
    return found.select(
        "source",
        "source_size",
        F.when(full, F.col("limit").cast("double"))
        .otherwise(F.col("first_open.level") * F.col("weight"))
        .alias("target"),
    )


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where budgets end: for each row of ``budgets`` (source, budget), the place
    ``edge`` below which all documents of ``sized`` (source, size, place) are taken,
    and of the ``tied`` equal rows at that place the number ``extra`` to take.

    ``extra`` brings the words taken nearest to the budget. A budget that is no more
    than 0, or not below its source's words, has no row.
    """
    spark = sized.sparkSession
    found = None
    open_ = staged(
        spark,
        budgets.where("budget > 0").select(
            F.col("source").alias("of"),
            "budget",
            F.col("budget").alias("left"),
            F.lit(0).cast("long").alias("bucket"),
        ),
        "mix-open",
    )
    for shift in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        inside = F.shiftright("place", shift + BUCKET_BITS) == F.col("bucket")
        histogram = (
            sized.join(open_, sized["source"].eqNullSafe(open_["of"]) & inside)
            .groupBy("of", "budget", "left", F.shiftright("place", shift).alias("bucket"))
            .agg(
                F.sum("size").alias("words"),
                F.count("*").alias("tied"),
                F.min("place").alias("edge"),
                F.max("place").alias("last"),
            )
        )
        running = F.sum("words").over(Window.partitionBy("of", "budget").orderBy("bucket"))
        boundary = histogram.withColumn("before", running - F.col("words")).where(
            (F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words"))
        )
        boundary = staged(
            spark, boundary.withColumn("left", F.col("left") - F.col("before")), "mix-boundary"
        )
        single = boundary.where("edge = last").select(
            F.col("of").alias("source"),
            "budget",
            "edge",
            "tied",
            F.floor(F.col("left") / (F.col("words") / F.col("tied")) + 0.5).alias("extra"),
        )
        found = single if found is None else found.unionByName(single)
        open_ = boundary.where("edge < last").select("of", "budget", "left", "bucket")
        if open_.isEmpty():
            break
    return staged(spark, found, "mix-thresholds")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns ``doc`` (the row as a struct, so no name can clash), ``size`` (words),
    ``source_size``, ``target`` (of its source), ``copies`` and ``taken`` (size times
    copies). Sizes, targets and copies depend on the rows alone: reruns agree.

    Null text has no words; null sources form one source, the last; null keys are
    like any other key. Documents without words take no budget. Equal rows (key, text
    and source) stand at one place and are told apart only by how many of them are
    taken. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        F.col(f"doc.{source}").alias("source"),
        word_count(F.col(f"doc.{text}")).alias("size"),
        place(F.col(f"doc.{key}"), F.col(f"doc.{text}")).alias("place"),
    )
    sized = staged(spark, rows.drop("doc"), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = staged(
        spark,
        allot(totals, weights, share, repeats).withColumn("whole", F.coalesce(whole, F.lit(0))),
        "mix-targets",
    )
    partial = targets.select(
        "source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")
    )
    edges = thresholds(sized, partial)
    plan = staged(
        spark,
        targets.alias("t")
        .join(edges.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left")
        .select(
            F.col("t.source").alias("of"),
            "source_size",
            "target",
            "whole",
            F.coalesce("edge", F.lit(0)).alias("edge"),
            F.coalesce("tied", F.lit(0)).alias("tied"),
            F.coalesce("extra", F.lit(0)).alias("extra"),
        ),
        "mix-plan",
    )
    placed = rows.join(plan, rows["source"].eqNullSafe(plan["of"]))
    more = (F.col("place") < F.col("edge")) | (
        (F.col("place") == F.col("edge")) & (F.col("extra") >= F.col("tied"))
    )
    if plan.where("extra > 0 and extra < tied").isEmpty():
        counted = placed.withColumn("copies", F.col("whole") + more.cast("long"))
    else:
        counted = _split_ties(placed, more)
    return counted.select(
        "doc",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _split_ties(placed: DataFrame, more: Column) -> DataFrame:
    """Copies when only some of the equal rows at a threshold are to be taken.

    The rows there are numbered in two steps, by task that reads them and within
    it, so that no task gathers them all.
    """
    at_edge = F.expr("place = edge and extra > 0 and extra < tied")
    plain = placed.where(~at_edge).withColumn("copies", F.col("whole") + more.cast("long"))
    tied = staged(
        placed.sparkSession,
        placed.where(at_edge).withColumn("task", F.spark_partition_id()),
        "mix-ties",
    )
    by_task = Window.partitionBy("of").orderBy("task")
    offsets = (
        tied.groupBy("of", "task")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("of").alias("of_task"),
            F.col("task").alias("in_task"),
            (F.sum("n").over(by_task) - F.col("n")).alias("offset"),
        )
    )
    within = F.row_number().over(Window.partitionBy("of", "task").orderBy(F.lit(0)))
    numbered = tied.withColumn("number", within).join(
        offsets, tied["of"].eqNullSafe(F.col("of_task")) & (tied["task"] == F.col("in_task"))
    )
    taken = (F.col("offset") + F.col("number") <= F.col("extra")).cast("long")
    return plain.unionByName(
        numbered.withColumn("copies", F.col("whole") + taken).select(*plain.columns)
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it."""
    counted = mix(docs, **options)
    once_each = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return counted.select("doc", once_each).select("doc.*")
