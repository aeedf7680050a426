"""Chat formatting by perspective rotation.

A conversation is rendered once for each of its participants: that speaker's turns
become the assistant's and are trained on, all others are named users. Instructions
(the ``system`` role) belong to nobody and head every rendering as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

INSTRUCTIONS = ("system",)
UNKNOWN = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: What marks of turns begin with, and what stands for it within texts.
MARKS = "<|im_", "<| im_"
#: Turns of a conversation that are put together in one row.
SEGMENT = 512


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    instructions: tuple[str, ...] = INSTRUCTIONS,
    segment: int = SEGMENT,
) -> DataFrame:
    """One rendering of every conversation per participant, in segments.

    Returns ``conv_id``, ``participant``, ``segment``, ``n_turns``, ``n_trained``,
    ``rendered`` and ``mask``: an array of (start, length) in code points of ``rendered``
    that the loss covers, the participant's words with their end mark. A conversation's
    turns are put in order of turn, role and text, nulls last; turns number ``k * segment`` to
    ``(k + 1) * segment - 1`` in that order make segment ``k``, so a conversation of any length,
    with any numbers or none, is whole but never one group. Concatenated in order, segments
    give the rendering.

    Participants are the roles that speak, without ``instructions``; a null role speaks as
    ``unknown``. Null turns follow all others. Null texts are empty. Rows without a conversation
    belong to none: each is a conversation of its own, without an id, equal ones too. Repeated
    rows are repeated turns. A conversation of instructions alone has nobody to train and no
    rendering. Marks of turns within a text or a role are blunted (MARKS), and a role's line
    ends are blanks, so that no words pass for a turn.
    """
    name = F.translate(F.coalesce(F.col(role), F.lit(UNKNOWN)), "\r\n", "  ")
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).isNull().alias("unnumbered"),
            F.col(turn).alias("turn"),
            _blunt(name).alias("role"),
            _blunt(F.coalesce(F.col(text), F.lit(""))).alias("text"),
            (name.isin(*instructions) if instructions else F.lit(False)).alias("instruction"),
        ).alias("entry"),
    )
    lone = rows.where(F.col("conv_id").isNull() & ~F.col("entry.instruction")).select(
        "conv_id",
        F.lit(0).cast("long").alias("segment"),
        F.array("entry").alias("turns"),
        F.array("entry.role").alias("participants"),
    )
    rows = rows.where("conv_id is not null")
    speaking = (
        rows.where(~F.col("entry.instruction"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_set("entry.role")).alias("participants"))
    )
    each = _segments(rows, segment).join(speaking, "conv_id").unionByName(lone)
    rotated = each.select(
        "conv_id", "segment", "turns", F.explode("participants").alias("participant")
    )
    return rotated.select(
        "conv_id",
        "participant",
        "segment",
        F.size("turns").cast("long").alias("n_turns"),
        _parts(F.col("turns"), F.col("participant")).alias("parts"),
    ).select(
        "conv_id",
        "participant",
        "segment",
        "n_turns",
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_trained"),
        F.concat_ws(
            "", F.transform("parts", lambda p: F.concat(p["head"], p["body"]))
        ).alias("rendered"),
        _mask(F.col("parts")).alias("mask"),
    )


def _blunt(text: Column) -> Column:
    """A text without marks of turns: a blank takes each apart."""
    return F.replace(text, F.lit(MARKS[0]), F.lit(MARKS[1]))


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """``conv_id``, ``segment`` and its ``turns`` in order, of rows (``conv_id``, ``entry``).

    Conversations of one segment are grouped at once. Longer ones, which may be any share of
    all rows, are sorted over tasks first: a turn's number is its place in its task's part of
    the conversation, and the turns in the parts before.
    """
    turns = F.sort_array(F.collect_list("entry")).alias("turns")
    long = rows.groupBy("conv_id").count().where(F.col("count") > segment).select("conv_id")
    long = staged(rows.sparkSession, long, "chat-long")
    short = rows.join(long, "conv_id", "left_anti").groupBy("conv_id").agg(turns)
    short = short.select("conv_id", F.lit(0).cast("long").alias("segment"), "turns")
    if long.isEmpty():
        return short
    order = ["conv_id", "entry", "copy"]  # equal turns may lie in several tasks
    spread = rows.join(long, "conv_id").withColumn("copy", F.monotonically_increasing_id())
    sorted_rows = (
        spread.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "entry", F.monotonically_increasing_id().alias("at"))
        .withColumn("part", F.shiftright("at", 33))
    )
    sorted_rows = staged(rows.sparkSession, sorted_rows, "chat-sorted")
    parts = sorted_rows.groupBy("conv_id", "part").agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.select(
        "conv_id", "part", "first", (F.sum("n").over(earlier) - F.col("n")).alias("before")
    )
    number = F.col("before") + F.col("at") - F.col("first")
    cut = sorted_rows.join(parts, ["conv_id", "part"]).select(
        "conv_id", F.floor(number / segment).alias("segment"), "entry"
    )
    return short.unionByName(cut.groupBy("conv_id", "segment").agg(turns))


def _parts(turns: Column, participant: Column) -> Column:
    """Each turn as ``head`` (its marks and name) and ``body`` (its words and end mark)."""

    def part(turn: Column) -> Column:
        own = ~turn["instruction"] & (turn["role"] == participant)
        head = (
            F.when(turn["instruction"], turn["role"])
            .when(own, F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), turn["role"]))
        )
        return F.struct(
            own.alias("own"),
            F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"),
            F.concat(turn["text"], F.lit(CLOSE)).alias("body"),
        )

    return F.transform(turns, part)


def _mask(parts: Column) -> Column:
    """Spans of the participant's bodies, from the running length of what stands before."""
    nothing = F.struct(
        F.lit(0).alias("length"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def add(state: Column, p: Column) -> Column:
        start = state["length"] + F.length(p["head"])
        size = F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size).alias("length"),
            F.when(p["own"], F.concat(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(parts, nothing, add, lambda state: state["spans"])


def staged_rotation(turns: DataFrame, **options) -> DataFrame:
    """:func:`rotate`, written to the shared folder once for several readers."""
    return staged(turns.sparkSession, rotate(turns, **options), "chat")
