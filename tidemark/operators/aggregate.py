"""Hourly aggregates per entity, and the refresh of only the hours a batch touches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.scalars import named

WEATHER_MEANS = {
    "avg_temperature": "temperature",
    "avg_humidity": "humidity",
    "avg_windspeed": "windspeed",
}
WEATHER_MAXIMA = {"max_temperature": "temperature"}


def with_hour(rows: DataFrame, event_time: str, width: str = "1 hour") -> DataFrame:
    """Add ``hour_start``; rows without an event time belong to no window."""
    return rows.withColumn("hour_start", scalars.hour_start(named(event_time), width))


def hourly_aggregate(
    rows: DataFrame,
    entity: str = "city",
    event_time: str = "event_time",
    means: Mapping[str, str] = WEATHER_MEANS,
    maxima: Mapping[str, str] = WEATHER_MAXIMA,
    round_to: int | None = 2,
    exact_digits: int | None = None,
    width: str = "1 hour",
) -> DataFrame:
    """Averages, maxima and the row count per entity and tumbling window.

    NULL measures are left out of averages and maxima but their rows count.
    Averages are rounded to ``round_to`` decimals, maxima are not.
    ``exact_digits`` sums the averaged columns as integers of that many
    decimals, so the result is the same for every partitioning and retry.

    The group keys are the entity and the start of the window alone. The end
    follows from the start, and a later join on (entity, hour_start) finds its
    rows already partitioned. Partial aggregation runs before the shuffle, so
    a hot entity costs each task one row per hour.
    """
    aggregates: list[Column] = []
    for alias, column in means.items():
        if exact_digits is None:
            mean = F.avg(named(column))
        else:
            mean = scalars.fixed_point_mean(named(column), exact_digits)
        aggregates.append((mean if round_to is None else F.round(mean, round_to)).alias(alias))
    for alias, column in maxima.items():
        aggregates.append(F.max(named(column)).alias(alias))
    aggregates.append(F.count(F.lit(1)).alias("record_count"))

    grouped = with_hour(rows, event_time, width).groupBy(entity, "hour_start").agg(*aggregates)
    return grouped.select(
        entity,
        "hour_start",
        scalars.hour_end(F.col("hour_start"), width).alias("hour_end"),
        *means,
        *maxima,
        "record_count",
    )


def touched_hours(increment: DataFrame, entity: str = "city", event_time: str = "event_time"):
    """The distinct (entity, hour_start) keys that an increment reaches."""
    return with_hour(increment, event_time).select(entity, "hour_start").distinct()


def only_touched(hours: DataFrame, touched: DataFrame, entity: str = "city") -> DataFrame:
    """The aggregated hours that an increment reaches.

    Aggregating only the new rows would be wrong for an hour that the mark cuts
    through, so whole hours are aggregated, and joined after that. Both sides have one
    row per key, so an inner join does; a semi join would be moved below the aggregation,
    to the raw rows.
    """
    return hours.join(touched, [entity, "hour_start"]).select(*hours.columns)
