"""From typed input rows to bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalars import parse_event_time, utc, utc_offset_label, year_month

UNKNOWN = "Unknown"


def dictionary_lookup(
    rows: DataFrame,
    key: str,
    dictionary: DataFrame,
    code: str,
    name: str,
    into: str,
    default: str = UNKNOWN,
) -> DataFrame:
    """Add ``into``: the dictionary's name for ``key``, or ``default``.

    NULL and unlisted keys get the default. A dictionary has one entry per
    code, so repeated codes are reduced to their greatest name first and can
    never multiply rows. Spark broadcasts it when its size allows; beyond that
    the join shuffles and adaptive execution splits hot keys.
    """
    entries = dictionary.groupBy(F.col(code).alias("__code")).agg(F.max(name).alias("__name"))
    return (
        rows.join(entries, rows[key] == F.col("__code"), "left")
        .withColumn(into, F.coalesce(F.col("__name"), F.lit(default)))
        .drop("__code", "__name")
    )


def to_bronze(inputs: DataFrame, countries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Input rows to the fourteen bronze columns; ``countries`` holds (code, name).

    Columns of ``inputs`` named in ``keep`` follow after them.
    """
    event_time = parse_event_time(F.col("timestamp"))
    derived = {
        "timeZone": utc_offset_label(F.col("timezone")),
        "event_time": event_time,
        **year_month(utc(event_time)),
    }
    plain = [name for name in schemas.BRONZE.names if name not in (*derived, "country")]
    rows = inputs.select(*plain, *keep, *[value.alias(name) for name, value in derived.items()])
    named = dictionary_lookup(rows, "countrycode", countries, "code", "name", "country")
    return named.select(*schemas.BRONZE.names, *keep)


def rejection(faults: Column | None = None) -> Column:
    """Why a bronze row can be neither aggregated nor merged, or, given the ``faults`` of its
    payload, which of its values is not of its type; NULL for all others."""
    reason = F.when(F.col("city").isNull(), F.lit("no city"))
    if faults is not None:
        named = F.concat(F.lit("wrong type: "), F.array_join(faults, ", "))
        reason = reason.when(F.size(faults) > 0, named)
    return reason.when(F.col("event_time").isNull(), F.lit("no event time"))


def is_acceptable() -> Column:
    return rejection().isNull()
