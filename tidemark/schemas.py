"""Declared schemas. Nothing in the engine infers a schema from data."""

from pyspark.sql import types as T

# Field names and types of the source payload and of every table.
PAYLOAD_DDL = """
    main struct<temp: double, humidity: int>,
    dt bigint,
    weather array<struct<description: string>>,
    sys struct<sunrise: bigint, country: string>,
    wind struct<speed: double>,
    timezone bigint
"""

INPUT_DDL = """
    city string, temperature double, timestamp string, load_time string,
    description string, sunrise string, windspeed double, timezone bigint,
    countrycode string, humidity int
"""

BRONZE_DDL = """
    city string, temperature double, timestamp string, load_time string,
    description string, sunrise string, windspeed double, countrycode string,
    humidity int, timeZone string, event_time timestamp, country string,
    year int, month int
"""

SILVER_DDL = """
    city string, hour_start timestamp, hour_end timestamp,
    avg_temperature double, avg_humidity double, avg_windspeed double,
    max_temperature double, record_count bigint
"""

CONTROL_DDL = "TableName string, WatermarkValue string"

RUN_EVENT_DDL = "log_time timestamp, seq bigint, level string, message string"


ATOMIC = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def flat(ddl: str) -> T.StructType:
    """A flat struct from DDL, also before a session exists."""
    pairs = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, ATOMIC[kind]) for name, kind in pairs])


INPUT = flat(INPUT_DDL)
BRONZE = flat(BRONZE_DDL)
SILVER = flat(SILVER_DDL)
CONTROL = flat(CONTROL_DDL)
RUN_EVENT = flat(RUN_EVENT_DDL)

SILVER_KEYS = ("city", "hour_start")
SILVER_MEASURES = (
    "avg_temperature",
    "max_temperature",
    "avg_humidity",
    "avg_windspeed",
    "record_count",
)
