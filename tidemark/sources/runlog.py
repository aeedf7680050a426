"""The run log as an event table: one row per message, partitioned by day.

A text line has the form ``[yyyy-MM-dd HH:mm:ss] [LEVEL] message``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalars import TIMESTAMP_PATTERN, parse_plain_time, utc
from tidemark.shared import small_frame
from tidemark.sources.tables import table_exists

# Line format and levels.
LINE_PATTERN = r"^\[\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\] \[[A-Z]+\] "
STAMP_LENGTH = len("yyyy-MM-dd HH:mm:ss")
LEVEL_START = STAMP_LENGTH + 5
LEVELS = ("INFO", "ERROR")


def render_line(log_time: Column, level: Column, message: Column) -> Column:
    stamp = F.date_format(log_time, TIMESTAMP_PATTERN)
    return F.concat(F.lit("["), stamp, F.lit("] ["), level, F.lit("] "), message)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines to ``log_time, log_date, level, message``; other columns are kept.

    One pattern test decides whether a line has the form; its parts are then
    cut at fixed places. Other lines have NULL parts.
    """
    line = F.col(column)
    well_formed = line.rlike(LINE_PATTERN)
    rest = F.substr(line, F.lit(LEVEL_START))
    level = F.substring_index(rest, "]", 1)
    message = F.substr(rest, F.length(level) + 3)
    log_time = F.when(well_formed, parse_plain_time(F.substring(line, 2, STAMP_LENGTH)))
    return lines.withColumns(
        {
            "log_time": log_time,
            "log_date": F.to_date(utc(log_time)),
            "level": F.when(well_formed, level),
            "message": F.when(well_formed, message),
        }
    )


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``seq`` (the number of the line in its file, from 1) and ``value`` for every
    line of the text files at ``path``, however they are split and dealt to tasks.

    Lines are numbered within their split, and each split starts after all lines of the
    splits before it in the file. A split is numbered by one task, so files that cannot be
    split (compressed ones) are numbered whole.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    split = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("lines"))
    starts = counts.select(*split, F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("start"))
    # Only the order of these ids within a split is used, not the ids.
    within = Window.partitionBy(*split).orderBy("place")
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    numbered = placed.withColumn("number", F.row_number().over(within))
    joined = numbered.join(starts, split)
    return joined.select("file", (F.col("start") + F.col("number")).alias("seq"), "value")


def read_text_log(spark: SparkSession, path: str) -> DataFrame:
    """Parsed lines of text log files with their ``file`` and ``seq``, the number of the line
    in it. Lines without a time of their own keep their place between the others."""
    return parse_lines(number_lines(spark, path))


def tail_lines(log: DataFrame, count: int, level: str | None = None) -> DataFrame:
    """The last lines over several files, which follow each other by name, in their order."""
    chosen = log if level is None else log.filter(F.col("level") == level)
    last = chosen.orderBy(F.desc("file"), F.desc("seq")).limit(count)
    return last.orderBy("file", "seq")


def append_events(
    spark: SparkSession, path: str, events: list[tuple[str, str]], now: datetime | None = None
) -> None:
    """Append ``(level, message)`` pairs of one run to the event table."""
    stamp = now or datetime.now(timezone.utc)
    for level, _ in events:
        if level not in LEVELS:
            raise ValueError(f"unknown level {level!r}")
    first = int(stamp.timestamp() * 1_000_000)
    rows = [(stamp, first + n, level, message) for n, (level, message) in enumerate(events)]
    (
        small_frame(spark, rows, schemas.RUN_EVENT)
        .withColumn("log_date", F.to_date(utc(F.col("log_time"))))
        .coalesce(1)
        .write.partitionBy("log_date")
        .mode("append")
        .parquet(path)
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table; empty when nothing has been logged yet."""
    schema = schemas.RUN_EVENT_DDL + ", log_date date"
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def select_log(
    events: DataFrame,
    date: str | None = None,
    level: str | None = None,
    tail: int | None = None,
) -> DataFrame:
    """Entries of one day (today by default), of one level, or the last ``tail``.

    The level test is a substring match on ``[LEVEL]`` in the line, so a message
    that quotes another level's tag is found too. The tail is a top-N by
    descending order, never a sort of the whole day.
    """
    day = F.to_date(F.lit(date)) if date else F.current_date()
    chosen = events.filter(F.col("log_date") == day)
    if level:
        tag = f"[{level}]"
        chosen = chosen.filter((F.col("level") == level) | F.col("message").contains(tag))
    if tail:
        chosen = chosen.orderBy(F.desc("log_time"), F.desc("seq")).limit(tail)
    return chosen.orderBy("log_time", "seq")


def log_days(events: DataFrame) -> DataFrame:
    return events.select("log_date").distinct().orderBy("log_date")
