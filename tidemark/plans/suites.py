"""The bronze and silver suites of the hourly weather tables."""

from __future__ import annotations

from tidemark import schemas
from tidemark.operators.expectations import type_name
from tidemark.operators.suite import Suite, build_suite

# Parameters of the two suites.
CITIES = ["London", "New York", "Tokyo", "Sydney", "Mumbai"]
STAMP_FORMAT = "%Y-%m-%d %H:%M:%S"
STAMP_COLUMNS = ["timestamp", "load_time", "sunrise"]
BRONZE_ROW_COUNT = {"min_value": 1, "max_value": 1000}
TEMPERATURE_RANGE = {"min_value": 0, "max_value": 50}
BRONZE_REGEXES = {
    "load_time": r"(^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$)|(^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$)",  # noqa: E501
    "timeZone": r"(^UTC[+-](0[0-9]|1[0-4]):[0-5][0-9]$)",
    "countrycode": r"(^[a-zA-Z]{2}$)",
}
SILVER_UNIQUE = [["hour_start", "city"], ["hour_end", "city"]]


def bronze_suite(row_count: dict | None = BRONZE_ROW_COUNT) -> Suite:
    """The checks of the bronze table; ``row_count=None`` leaves the row bound out."""
    checked = [entry for entry in schemas.BRONZE.fields if entry.name not in ("year", "month")]
    names = [entry.name for entry in checked]
    return build_suite(
        name="bronze",
        row_count=row_count,
        column_count=len(schemas.BRONZE.fields),
        ordered_columns=schemas.BRONZE.names,
        in_set={"city": CITIES},
        not_null=names,
        exist=names,
        ranges={"temperature": TEMPERATURE_RANGE},
        regexes=BRONZE_REGEXES,
        types={entry.name: type_name(entry.dataType) for entry in checked},
        formats=dict.fromkeys(STAMP_COLUMNS, STAMP_FORMAT),
    )


def silver_suite() -> Suite:
    names = schemas.SILVER.names
    return build_suite(
        name="silver",
        ordered_columns=names,
        not_null=names,
        exist=names,
        unique=SILVER_UNIQUE,
        ranges={"max_temperature": TEMPERATURE_RANGE},
        types={entry.name: type_name(entry.dataType) for entry in schemas.SILVER.fields},
    )
