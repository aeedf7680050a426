from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import scalars


def one(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_epoch_to_string_is_utc_in_any_zone(spark):
    rows = [(1704067207,), (0,), (-5,), (1710054000,), (None,), (10**18,)]
    expected = [
        "2024-01-01 00:00:07",
        "1970-01-01 00:00:00",
        "1969-12-31 23:59:55",
        "2024-03-10 07:00:00",
        None,
        None,
    ]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = one(spark, scalars.epoch_to_string(F.col("s")), rows, "s bigint")
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == expected


def test_utc_offset_label(spark):
    rows = [(0,), (19800,), (-12600,), (-1800,), (50400,), (-43200,), (None,)]
    got = one(spark, scalars.utc_offset_label(F.col("s")), rows, "s bigint")
    assert got == [
        "UTC+00:00",
        "UTC+05:30",
        "UTC-03:30",
        "UTC-00:30",
        "UTC+14:00",
        "UTC-12:00",
        None,
    ]


def test_parse_event_time_gives_null_for_malformed_text(spark):
    rows = [("2025-01-02 03:04:05",), ("garbage",), (None,), ("2025-02-30 00:00:00",)]
    got = one(spark, scalars.parse_event_time(F.col("t")), rows, "t string")
    assert got == [datetime(2025, 1, 2, 3, 4, 5), None, None, None]


def test_load_stamp_is_fixed_by_as_of(spark):
    assert one(spark, scalars.load_stamp("2024-02-01 00:00:00"), [(1,)], "x int") == [
        "2024-02-01 00:00:00"
    ]
    stamp = one(spark, scalars.load_stamp(), [(1,)], "x int")[0]
    assert datetime.strptime(stamp, "%Y-%m-%d %H:%M:%S")


def test_hour_bucket_is_epoch_aligned_and_keeps_its_type(spark):
    df = spark.createDataFrame(
        [("1969-12-31 23:59:59",), ("2024-01-01 10:00:00",), ("2024-01-01 10:59:59",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    bucket = df.select(scalars.hour_start(F.col("t")).alias("h"))
    assert bucket.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert [r[0] for r in bucket.collect()] == [
        datetime(1969, 12, 31, 23),
        datetime(2024, 1, 1, 10),
        datetime(2024, 1, 1, 10),
    ]


def test_fixed_point_mean_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9 - 0.01, 490.02] * 50 + [None] * 7
    means = set()
    for rows in (values, values[::-1], sorted(values, key=lambda v: (v is None, v))):
        df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(7)
        means.add(df.agg(scalars.fixed_point_mean(F.col("v"), 2)).first()[0])
    assert means == {(10 + 20 + 30 + 49002) / 100 / 6}


def test_fixed_point_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(scalars.fixed_point_mean(F.col("v"), 2)).first()[0] is None


def test_fixed_point_refuses_to_round(spark):
    df = spark.createDataFrame([(1.005,)], "v double")
    with pytest.raises(PySparkException, match="more than 2 decimals"):
        df.select(scalars.fixed_point(F.col("v"), 2)).collect()


@pytest.mark.parametrize(
    "text, matches",
    [
        ("2025-01-02 03:04:05", True),
        ("2025-1-1 0:0:0", True),
        ("2025-02-30 00:00:00", False),
        ("2025-01-01T00:00:00", False),
        ("2025-01-01 00:00:00 ", False),
        ("", False),
    ],
)
def test_strftime_match_reads_like_strptime(spark, text, matches):
    column = scalars.matches_strftime(F.col("t"), "%Y-%m-%d %H:%M:%S")
    assert one(spark, column, [(text,)], "t string") == [matches]
    try:
        datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        assert matches
    except ValueError:
        assert not matches


def test_strptime_pattern_quotes_letters_and_rejects_unknown_directives():
    assert scalars.strptime_pattern("%Y-%m-%dT%H:%M") == "yyyy-M-d'T'H:m"
    with pytest.raises(ValueError):
        scalars.strptime_pattern("%Q")
