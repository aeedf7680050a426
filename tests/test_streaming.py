import pytest

from helpers import payload_frame, sorted_rows
from test_refresh import STAMPS, full, job, observations, silver
from tidemark.operators.aggregate import hourly_aggregate
from tidemark.plans import store
from tidemark.streaming.refresh import (
    process_batch,
    read_payload_stream,
    start_refresh,
)


def land(folder, name, rows):
    for number, (city, payload) in enumerate(rows):
        target = folder / f"city={city}"
        target.mkdir(parents=True, exist_ok=True)
        with open(target / f"{name}.json", "a") as file:
            file.write(payload + "\n")


def run_stream(spark, refresh, tmp_path, files=3, **options):
    stream = read_payload_stream(spark, str(tmp_path / "landed"), files)
    query = start_refresh(refresh, stream, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("order", [1, -1])
def test_stream_equals_batch_in_any_file_order(spark, tmp_path, countries, order):
    rows = observations(STAMPS)
    pieces = [rows[n::3] for n in range(3)] if order < 0 else [rows[:80], rows[80:160], rows[160:]]
    refresh = job(tmp_path, countries)
    for number, piece in enumerate(pieces[::order]):
        land(tmp_path / "landed", f"part{number}", piece)
        run_stream(spark, refresh, tmp_path)
    expected = sorted_rows(hourly_aggregate(refresh.bronze_rows(payload_frame(spark, rows))))
    assert silver(spark, refresh) == expected == full(spark, refresh)


def test_a_replayed_batch_changes_nothing(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS[:6])
    process_batch(refresh, payload_frame(spark, rows[:20]), 0)
    process_batch(refresh, payload_frame(spark, rows[20:]), 1)
    before = silver(spark, refresh)
    process_batch(refresh, payload_frame(spark, rows[20:]), 1)
    assert silver(spark, refresh) == before == full(spark, refresh)
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)


def test_dropping_late_rows_is_opt_in_and_replayable(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    early, late = observations(STAMPS[5:6]), observations(STAMPS[2:3])
    newer = observations(STAMPS[7:8])
    process_batch(refresh, payload_frame(spark, [("London", "broken")]), 0, drop_late=True)
    process_batch(refresh, payload_frame(spark, early), 1, drop_late=True)
    for _ in range(2):
        process_batch(refresh, payload_frame(spark, late + newer), 2, drop_late=True)
    process_batch(refresh, payload_frame(spark, early), 1, drop_late=True)
    assert store.read_bronze(spark, refresh.layout).count() == len(early) + len(newer)
    assert silver(spark, refresh) == full(spark, refresh)


def test_late_rows_may_be_dropped_from_any_batch_on(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    early, late = observations(STAMPS[5:6]), observations(STAMPS[2:3])
    process_batch(refresh, payload_frame(spark, early), 0)
    for _ in range(2):
        process_batch(refresh, payload_frame(spark, late + observations(STAMPS[6:7])), 1, drop_late=True)
    process_batch(refresh, payload_frame(spark, late), 2)
    assert store.read_bronze(spark, refresh.layout).count() == len(early) * 2 + len(late)
    assert silver(spark, refresh) == full(spark, refresh)


def test_streams_and_the_job_share_a_root(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    parts = [observations(STAMPS[n : n + 1]) for n in range(6)]
    process_batch(refresh, payload_frame(spark, parts[3]), 0, drop_late=True, source="a")
    refresh.run(spark, payload_frame(spark, parts[0]))
    process_batch(refresh, payload_frame(spark, parts[1]), 0, drop_late=True, source="b")
    process_batch(refresh, payload_frame(spark, parts[2]), 1, drop_late=True, source="a")
    refresh.run(spark, payload_frame(spark, parts[4]))
    process_batch(refresh, payload_frame(spark, parts[5]), 1, drop_late=True, source="b")
    kept = {r[0] for r in store.read_bronze(spark, refresh.layout).select("timestamp").collect()}
    assert {stamp[:13] for stamp in kept} == {STAMPS[n][:13] for n in (0, 1, 3, 4, 5)}
    assert silver(spark, refresh) == full(spark, refresh)
