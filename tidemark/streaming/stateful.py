"""The hourly aggregate kept in Spark's state store, for streams without a bronze table.

State is one row per city and open hour: sums as integers, counts and maxima, so a batch
adds to it and nothing is read again. An hour is put out once, when the watermark has passed
its end. What comes later than the delay is dropped, and counted.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions.scalars import fixed_point, named
from tidemark.operators.aggregate import WEATHER_MAXIMA, WEATHER_MEANS
from tidemark.shared import path_exists, read_text, small_frame, write_text


RETENTION = "spark.sql.streaming.numRecentProgressUpdates"
#: Batches of one run whose counts of rows are kept until it ends.
MOST_BATCHES = 100_000


def _aggregates(means: Mapping[str, str], maxima: Mapping[str, str], digits: int) -> list:
    sums = []
    for alias, column in means.items():
        units = fixed_point(named(column), digits)
        sums += [F.sum(units).alias(f"sum_{alias}"), F.count(units).alias(f"count_{alias}")]
    tops = [F.max(named(column)).alias(alias) for alias, column in maxima.items()]
    return [*sums, *tops, F.count(F.lit(1)).alias("record_count")]


def open_hours(
    rows: DataFrame,
    delay: str,
    entity: str = "city",
    event_time: str = "event_time",
    means: Mapping[str, str] = WEATHER_MEANS,
    maxima: Mapping[str, str] = WEATHER_MAXIMA,
    digits: int = 2,
) -> DataFrame:
    """Hourly state of a stream: integer sums and counts, maxima and the row count."""
    timed = rows.withWatermark(event_time, delay)
    return timed.groupBy(named(entity), F.window(named(event_time), "1 hour")).agg(
        *_aggregates(means, maxima, digits)
    )


def closed_hours(
    state: DataFrame,
    entity: str = "city",
    means: Mapping[str, str] = WEATHER_MEANS,
    maxima: Mapping[str, str] = WEATHER_MAXIMA,
    digits: int = 2,
    round_to: int | None = 2,
) -> DataFrame:
    """Hours as the silver table has them, from their state."""
    averages = []
    for alias in means:
        total = F.col(f"sum_{alias}").cast("double") / float(10**digits)
        mean = total / F.nullif(F.col(f"count_{alias}"), F.lit(0))
        averages.append((mean if round_to is None else F.round(mean, round_to)).alias(alias))
    return state.select(
        entity,
        F.col("window.start").alias("hour_start"),
        F.col("window.end").alias("hour_end"),
        *averages,
        *maxima,
        "record_count",
    )


@dataclass
class StatefulRun:
    """What one run of the stream has done, and all runs on its checkpoint together."""

    read_rows: int
    emitted_rows: int
    open_rows: int
    dropped_rows: int | None
    watermark: str | None


def run_stateful(
    spark: SparkSession, rows: DataFrame, path: str, checkpoint: str, delay: str, digits: int = 2
) -> StatefulRun:
    """Process what has landed and stop; run it again on a schedule.

    ``rows`` is a stream of bronze rows. Hours that are over by ``delay`` are appended to the
    table at ``path``, each once, also when a run is stopped and repeated. Measures have at
    most ``digits`` decimals; others raise. Rows that no hour can take, because they came
    later than the delay, are the ones read that are neither in an hour put out nor in an
    open one, for as long as the checkpoint lasts.
    """
    seen = rows.observe("rows_read", F.count(F.lit(1)).alias("n"))
    kept = spark.conf.get(RETENTION)
    spark.conf.set(RETENTION, MOST_BATCHES)  # the query keeps what it is at its start
    try:
        query = _started(seen, path, checkpoint, delay, digits)
    finally:
        spark.conf.set(RETENTION, kept)
    query.awaitTermination()
    return _account(spark, query, path, checkpoint)


def _started(
    rows: DataFrame, path: str, checkpoint: str, delay: str, digits: int
) -> StreamingQuery:
    return (
        closed_hours(open_hours(rows, delay, digits=digits), digits=digits)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _account(spark: SparkSession, query: StreamingQuery, path: str, checkpoint: str) -> StatefulRun:
    """Rows read by batch are kept beside the checkpoint, by number: a batch that is repeated
    counts once. When the counts of some batch are missing, because a run was stopped after
    it, how many rows were dropped is not known."""
    book = f"{checkpoint}.rows.json"
    read = json.loads(read_text(spark, book) or "{}")
    watermark = None
    for progress in query.recentProgress:
        counted = progress.observedMetrics.get("rows_read")
        if counted is not None:
            read[str(progress.batchId)] = counted["n"]
        watermark = progress.eventTime.get("watermark", watermark)
    write_text(spark, book, json.dumps(read))
    emitted = read_hours(spark, path).agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
    waiting = hours_in_state(spark, checkpoint).agg(F.coalesce(F.sum("record_count"), F.lit(0)))
    still_open, total = waiting.first()[0], sum(read.values())
    whole = set(map(int, read)) == set(range(len(read)))
    dropped = total - emitted - still_open if whole else None
    return StatefulRun(total, emitted, still_open, dropped, watermark)


def hours_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The open hours of a stream as its state store has them: city, hour and state."""
    schema = T.StructType().add("city", "string").add("hour_start", "timestamp")
    schema = schema.add("record_count", "long")
    if not path_exists(spark, f"{checkpoint}/state/0/0"):
        return small_frame(spark, [], schema)
    state = spark.read.format("statestore").load(checkpoint)
    # Buffers of aggregates share names; the row count is the last one.
    kinds = [entry.dataType.simpleString() for entry in state.schema["value"].dataType.fields]
    apart = ", ".join(f"f{n}: {kind}" for n, kind in enumerate(kinds))
    return state.select(
        F.col("key.city").alias("city"),
        F.col("key.window.start").alias("hour_start"),
        F.col("value").cast(f"struct<{apart}>")[f"f{len(kinds) - 1}"].alias("record_count"),
    )


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hours that the stream has put out."""
    if not path_exists(spark, f"{path}/_spark_metadata"):
        return small_frame(spark, [], schemas.SILVER)
    return spark.read.schema(schemas.SILVER).parquet(path)
