"""The stateful stream against the batch aggregate."""

from datetime import datetime

from pyspark.sql import functions as F

from helpers import document, payload_frame, sorted_rows
from test_refresh import AS_OF, CITIES, STAMPS, observations
from test_streaming import land
from tidemark.functions.scalars import parse_event_time
from tidemark.operators.aggregate import hourly_aggregate
from tidemark.sources.payloads import flatten_payloads
from tidemark.streaming.refresh import read_payload_stream
from tidemark.streaming.stateful import hours_in_state, read_hours, run_stateful


def timed(frame):
    return flatten_payloads(frame, AS_OF).select(
        "city", parse_event_time(F.col("timestamp")).alias("event_time"),
        "temperature", "humidity", "windspeed",
    )


def run(spark, tmp_path, delay):
    rows = timed(read_payload_stream(spark, str(tmp_path / "landed"), 1))
    return run_stateful(spark, rows, str(tmp_path / "hours"), str(tmp_path / "checkpoint"), delay)


def test_hours_are_put_out_once_and_wait_for_the_delay(spark, tmp_path):
    rows = observations(STAMPS[:10], ["London"])
    whole = hourly_aggregate(timed(payload_frame(spark, rows)), exact_digits=2)
    for number, part in enumerate((rows[:8], rows[8:16:2], rows[9:16:2], rows[16:])):
        land(tmp_path / "landed", f"part{number}", part)
        last = run(spark, tmp_path, "3 hours")
    out = read_hours(spark, str(tmp_path / "hours"))
    closed = whole.filter(F.col("hour_end") <= F.lit(datetime(2024, 1, 31, 2, 35)))
    assert sorted_rows(out) == sorted_rows(closed) and out.count() == 6
    assert last.read_rows == len(rows) and last.dropped_rows == 0
    assert last.emitted_rows + last.open_rows == len(rows)
    waiting = {r["hour_start"].hour for r in hours_in_state(spark, str(tmp_path / "checkpoint")).collect()}
    assert waiting == {2, 3, 4, 5}


def test_rows_beyond_the_delay_are_counted(spark, tmp_path):
    land(tmp_path / "landed", "a", observations(STAMPS[:1], ["London"]) + observations(STAMPS[8:9], ["London"]))
    run(spark, tmp_path, "1 hour")
    land(tmp_path / "landed", "b", observations(STAMPS[2:4], CITIES) + observations(STAMPS[9:10], ["London"]))
    last = run(spark, tmp_path, "1 hour")
    assert last.dropped_rows == 2 * 2 * len(CITIES)
    assert last.read_rows == 2 + 2 + 12 + 2
    again = run(spark, tmp_path, "1 hour")
    assert (again.read_rows, again.dropped_rows) == (last.read_rows, last.dropped_rows)


def test_rows_without_a_time_or_a_city_take_no_state(spark, tmp_path):
    land(tmp_path / "landed", "a", [("London", document(None)), ("London", "broken")])
    land(tmp_path / "landed", "b", observations(STAMPS[:3], ["London"]))
    land(tmp_path / "landed", "c", observations(STAMPS[30:31], ["London"]))
    run(spark, tmp_path, "1 hour")
    assert read_hours(spark, str(tmp_path / "hours")).count() == 3
