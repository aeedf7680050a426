"""Small inputs and plan inspection shared by the tests."""

import json
from datetime import datetime, timedelta, timezone

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def seconds(stamp: str) -> int:
    moment = datetime.strptime(stamp, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return int((moment - EPOCH).total_seconds())


def document(stamp: str | None, temp=10.0, humidity=50, speed=3.0, country="GB", offset=0) -> str:
    dt = None if stamp is None else seconds(stamp)
    sunrise = None if dt is None else dt - dt % 86400 + 6 * 3600
    return json.dumps(
        {
            "main": {"temp": temp, "humidity": humidity},
            "dt": dt,
            "weather": [{"description": "clear sky"}],
            "sys": {"sunrise": sunrise, "country": country},
            "wind": {"speed": speed},
            "timezone": offset,
        }
    )


def payload_frame(spark, rows):
    return spark.createDataFrame(rows, "city string, payload string")


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def hours_after(start: str, count: int) -> list[str]:
    first = datetime.strptime(start, "%Y-%m-%d %H:%M:%S")
    return [(first + timedelta(hours=n)).strftime("%Y-%m-%d %H:%M:%S") for n in range(count)]
