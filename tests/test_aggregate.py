from datetime import datetime

from pyspark.sql import functions as F

from helpers import sorted_rows
from tidemark import schemas
from tidemark.operators.aggregate import hourly_aggregate, only_touched, touched_hours
from tidemark.sources.tables import latest_first

SCHEMA = "city string, event_time timestamp, temperature double, humidity int, windspeed double"


def at(hour, minute=0, second=0):
    return datetime(2024, 1, 1, hour, minute, second)


def bronze(spark):
    rows = [
        ("London", at(10), 1.0, 50, 1.0),
        ("London", at(10, 59, 59), 2.005, None, 2.0),
        ("London", at(11), None, 60, None),
        ("Tokyo", at(10, 30), 30.1234, 70, 3.0),
        ("Tokyo", None, 99.0, 70, 3.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_hourly_aggregate(spark):
    silver = hourly_aggregate(bronze(spark))
    assert silver.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SILVER.fields]
    assert sorted_rows(silver) == [
        ("London", at(10), at(11), 1.5, 50.0, 1.5, 2.005, 2),
        ("London", at(11), at(12), None, 60.0, None, None, 1),
        ("Tokyo", at(10), at(11), 30.12, 70.0, 3.0, 30.1234, 1),
    ]


def test_averages_round_half_up_on_the_decimal_text(spark):
    rows = [("a", at(1), 1.005, 1, 1.0), ("b", at(1), 2.675, 1, 1.0), ("c", at(1), -1.005, 1, 1.0)]
    silver = hourly_aggregate(spark.createDataFrame(rows, SCHEMA)).orderBy("city")
    assert [r["avg_temperature"] for r in silver.collect()] == [1.01, 2.68, -1.01]


def test_exact_digits_agree_with_plain_averages(spark):
    rows = [
        ("a" if n % 3 else "b", at(n % 5, n % 60), n % 97 / 4, n % 50, n % 7 / 2)
        for n in range(500)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted_rows(hourly_aggregate(df)) == sorted_rows(hourly_aggregate(df, exact_digits=2))


def test_touched_hours_bring_back_old_rows(spark):
    rows = bronze(spark)
    increment = rows.filter(F.col("event_time") > F.lit(at(10, 45)))
    touched = touched_hours(increment)
    assert sorted_rows(touched) == [("London", at(10)), ("London", at(11))]
    again = only_touched(hourly_aggregate(rows), touched)
    full = hourly_aggregate(rows).filter("city = 'London'")
    assert sorted_rows(again) == sorted_rows(full)


def test_display_order(spark):
    shown = latest_first(hourly_aggregate(bronze(spark)), 2).collect()
    assert [(r["city"], r["hour_start"]) for r in shown] == [("London", at(11)), ("London", at(10))]
    assert latest_first(hourly_aggregate(bronze(spark)), None).count() == 3
