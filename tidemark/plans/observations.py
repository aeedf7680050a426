"""The given ``events`` table read as weather observations.

Every event becomes one landed JSON payload, so the ingest path has real work
to do. ``nation`` is the dictionary of country codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import to_bronze
from tidemark.sources.payloads import flatten_payloads

AS_OF = "2024-02-01 00:00:00"
CITY_OF = {
    "click": "London",
    "view": "New York",
    "purchase": "Tokyo",
    "error": "Sydney",
    "signup": "Mumbai",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offset_seconds() -> Column:
    user = F.col("user_id")
    return (user % 27 - 12) * 3600 + (user % 4) * 900


def _city() -> Column:
    city = F.lit(None).cast("string")
    for event_type, name in CITY_OF.items():
        city = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(city)
    return city


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(city, payload)``; two country codes in 27 are not in the dictionary."""
    return rendered(table(spark, sf_dir, "events"))


#: The columns of events that payloads are made of.
RENDERED = ("ts", "user_id", "event_type", "value", "props")


def rendered(events: DataFrame) -> DataFrame:
    """Events as ``(city, payload)``, with their ``ts``."""
    user, ts = F.col("user_id"), F.col("ts")
    humidity = F.from_json("props", "k int")["k"]
    seconds = F.unix_timestamp(ts)
    sunrise = seconds - seconds % 86400 + 6 * 3600
    country = F.concat(F.lit("N"), F.char(user % 27 + 65))
    document = F.struct(
        F.struct(F.col("value").alias("temp"), humidity.alias("humidity")).alias("main"),
        F.unix_timestamp(ts).alias("dt"),
        F.array(F.struct(F.col("event_type").alias("description"))).alias("weather"),
        F.struct(sunrise.alias("sunrise"), country.alias("country")).alias("sys"),
        F.struct(((user % 300) / 10).alias("speed")).alias("wind"),
        offset_seconds().alias("timezone"),
    )
    return events.select(
        _city().alias("city"), F.to_json(document).alias("payload"), "ts"
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.lit("N"), F.char(F.col("n_nationkey").cast("bigint") + 65))
    return table(spark, sf_dir, "nation").select(code.alias("code"), F.col("n_name").alias("name"))


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_payloads(payloads(spark, sf_dir), AS_OF)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(inputs(spark, sf_dir), countries(spark, sf_dir))
