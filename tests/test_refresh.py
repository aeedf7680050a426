import itertools

import pytest
from pyspark.sql import functions as F

from helpers import document, hours_after, payload_frame, sorted_rows
from tidemark import schemas
from tidemark.operators.aggregate import hourly_aggregate
from tidemark.operators.suite import ValidationFailed, validate
from tidemark.plans import reports, store
from tidemark.plans.refresh import CUMULATIVE, INCREMENT, Refresh
from tidemark.plans.store import Layout
from tidemark.plans.suites import bronze_suite, silver_suite
from tidemark.shared import child_names
from tidemark.sources import runlog

AS_OF = "2024-02-01 00:00:00"
CITIES = ["London", "Tokyo", "Mumbai"]
STAMPS = hours_after("2024-01-30 20:00:00", 40)


def observations(stamps, cities=CITIES, base=10.0):
    return [
        (city, document(stamp[:14] + f"{minute:02d}:00", temp=base + n % 7, humidity=40 + n % 9))
        for n, (stamp, city, minute) in enumerate(itertools.product(stamps, cities, (5, 35)))
    ]


def job(tmp_path, countries, **options):
    return Refresh(Layout(str(tmp_path / "root")), countries, as_of=AS_OF, **options)


def silver(spark, refresh):
    return sorted_rows(store.read_silver(spark, refresh.layout.silver))


def full(spark, refresh):
    return sorted_rows(hourly_aggregate(store.read_bronze(spark, refresh.layout)))


def mark(spark, refresh):
    generation = store.latest_generation(spark, refresh.layout)
    return store.read_mark(spark, refresh.layout, refresh.table_name, generation)


def test_two_runs_equal_one_pass_and_a_third_changes_nothing(spark, tmp_path, countries):
    refresh = job(
        tmp_path, countries, bronze_suite=bronze_suite(), silver_suite=silver_suite()
    )
    rows = observations(STAMPS)
    half = len(rows) // 2 + 1
    first = refresh.run(spark, payload_frame(spark, rows[:half]))
    second = refresh.run(spark, payload_frame(spark, rows))
    assert first.accepted_rows + second.accepted_rows == store.read_bronze(
        spark, refresh.layout
    ).count()
    before = silver(spark, refresh)
    assert before == full(spark, refresh)
    assert mark(spark, refresh) == second.new_mark == "2024-02-01 11:35:00"

    third = refresh.run(spark, payload_frame(spark, rows))
    assert third.accepted_rows == 0 and third.new_mark == second.new_mark
    assert silver(spark, refresh) == before

    assert second.silver_report.success
    failed = [r["column"] for r in second.bronze_report.rows if not r["success"]]
    assert failed == []
    assert reports.read_runs(spark, refresh.layout.reports).count() == 5
    log = runlog.read_events(spark, refresh.layout.runlog)
    assert log.filter("message = 'no new rows, the mark stays'").count() == 1


def test_late_rows_are_dropped_also_for_other_cities(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    refresh.run(spark, payload_frame(spark, observations(STAMPS[5:6], ["London"])))
    late = observations(STAMPS[2:3], ["Tokyo"]) + observations(STAMPS[6:7], ["Tokyo"])
    refresh.run(spark, payload_frame(spark, late))
    kept = store.read_bronze(spark, refresh.layout)
    assert kept.filter("city = 'Tokyo'").count() == 2
    assert silver(spark, refresh) == full(spark, refresh)


def test_an_hour_the_mark_cuts_through_is_aggregated_whole(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    refresh.run(spark, payload_frame(spark, [("London", document("2024-01-01 10:10:00", 10.0))]))
    refresh.run(spark, payload_frame(spark, [("London", document("2024-01-01 10:50:00", 20.0))]))
    (row,) = silver(spark, refresh)
    assert row[3] == 15.0 and row[-1] == 2


def test_unusable_rows_are_kept_apart_on_every_run(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    good = observations(STAMPS[:2])
    refresh.run(spark, payload_frame(spark, [*good, ("London", "broken"), (None, good[0][1])]))
    refresh.run(spark, payload_frame(spark, [*observations(STAMPS[3:4]), ("Tokyo", '{"cod": 404}')]))
    assert store.read_rejected(spark, refresh.layout).count() == 3
    assert store.read_bronze(spark, refresh.layout).count() == len(good) + 6
    assert silver(spark, refresh) == full(spark, refresh)


def test_a_run_without_usable_rows_keeps_its_rejects(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    first = refresh.run(spark, payload_frame(spark, [("London", "broken")]))
    assert first.new_mark is None and mark(spark, refresh) is None
    refresh.run(spark, payload_frame(spark, observations(STAMPS[:1])))
    assert store.read_rejected(spark, refresh.layout).count() == 1
    assert silver(spark, refresh) == full(spark, refresh)


@pytest.mark.parametrize("step", ["write_slice", "stage_updates", "merge_staged", "write_mark"])
def test_a_run_that_stops_midway_is_repeated_without_a_trace(
    spark, tmp_path, countries, monkeypatch, step
):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS)
    refresh.run(spark, payload_frame(spark, rows[:48]))

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, step, stop)
        with pytest.raises(RuntimeError):
            refresh.run(spark, payload_frame(spark, rows))
    refresh.run(spark, payload_frame(spark, rows))
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)
    assert silver(spark, refresh) == full(spark, refresh)


@pytest.mark.parametrize(
    "step", ["read_slice", "stage_updates", "merge_staged", "write_mark", "write_source", "forget_pending"]
)
def test_the_batch_after_a_stopped_run_loses_nothing(
    spark, tmp_path, countries, monkeypatch, step
):
    refresh = job(
        tmp_path, countries, bronze_suite=bronze_suite(), silver_suite=silver_suite(),
        scope=CUMULATIVE,
    )
    rows = observations(STAMPS)
    parts = [rows[:48], rows[48:120], rows[120:]]
    refresh.run(spark, payload_frame(spark, parts[0]))

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, step, stop)
        with pytest.raises(RuntimeError):
            refresh.run(spark, payload_frame(spark, parts[1]))
    last = refresh.run(spark, payload_frame(spark, parts[2]))
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)
    assert silver(spark, refresh) == full(spark, refresh)
    assert mark(spark, refresh) == last.new_mark == "2024-02-01 11:35:00"
    assert store.pending_slices(spark, refresh.layout) == {}
    whole = validate(store.read_bronze(spark, refresh.layout), bronze_suite())
    assert last.bronze_report.rows == whole.rows
    log = runlog.read_events(spark, refresh.layout.runlog)
    assert log.filter("level = 'ERROR' and message = 'run stopped by RuntimeError: stopped'").count() == 1


def test_a_failed_gate_is_finished_by_the_next_run(spark, tmp_path, countries):
    strict = {"bronze_suite": bronze_suite({"min_value": 1000}), "on_failure": "raise"}
    refresh = job(tmp_path, countries, **strict)
    rows = observations(STAMPS)
    with pytest.raises(ValidationFailed):
        refresh.run(spark, payload_frame(spark, rows[:48]))
    assert mark(spark, refresh) is None
    with pytest.raises(ValidationFailed):
        refresh.run(spark, payload_frame(spark, rows[48:]))
    assert mark(spark, refresh) == "2024-01-31 03:35:00"
    job(tmp_path, countries).run(spark, payload_frame(spark, rows[:0] or [("London", "broken")]))
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)
    assert silver(spark, refresh) == full(spark, refresh)


def test_an_engine_error_in_a_check_does_not_move_the_mark(
    spark, tmp_path, countries, monkeypatch
):
    refresh = job(tmp_path, countries, bronze_suite=bronze_suite())

    def damaged(*args):
        return spark.range(1).select(F.raise_error(F.lit("damaged file")).alias("city"))

    with monkeypatch.context() as patch:
        patch.setattr(store, "as_stored", damaged)
        with pytest.raises(Exception, match="damaged file"):
            refresh.run(spark, payload_frame(spark, observations(STAMPS[:2])))
    assert mark(spark, refresh) is None


def test_counts_of_what_was_left_out(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS[:4])
    first = refresh.run(spark, payload_frame(spark, [*rows, ("London", "broken"), (None, "{}")]))
    assert (first.accepted_rows, first.rejected_rows, first.late_rows) == (len(rows), 2, 0)
    second = refresh.run(spark, payload_frame(spark, [*rows, ("Tokyo", "[]")]))
    assert (second.accepted_rows, second.rejected_rows, second.late_rows) == (0, 1, len(rows))
    kept = {tuple(r)[:3] for r in store.read_rejected(spark, refresh.layout).collect()}
    assert kept == {("London", "broken", "no event time"), (None, "{}", "no city"), ("Tokyo", "[]", "no event time")}


def test_old_control_files_are_removed(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    for n in range(6):
        refresh.run(spark, payload_frame(spark, observations(STAMPS[n : n + 1])))
    names = child_names(spark, refresh.layout.control)
    assert names == ["generation=4", "generation=5", "generation=6"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_the_session_zone_changes_nothing(spark, tmp_path, countries, zone):
    rows = observations(STAMPS)
    results = []
    for n, session_zone in enumerate(("UTC", zone)):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            refresh = job(tmp_path / str(n), countries)
            for part in (rows[:50], rows[50:]):
                refresh.run(spark, payload_frame(spark, part))
            assert spark.conf.get("spark.sql.session.timeZone") == session_zone
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        stored = store.read_bronze(spark, refresh.layout)
        results.append((silver(spark, refresh), sorted_rows(stored)))
    assert results[0] == results[1]


def test_a_merge_that_stops_before_publishing_is_finished_later(
    spark, tmp_path, countries, monkeypatch
):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS)
    refresh.run(spark, payload_frame(spark, rows[:100]))
    before = silver(spark, refresh)
    calls = []

    def stop(*args):
        calls.append(args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", stop)
        with pytest.raises(RuntimeError):
            refresh.run(spark, payload_frame(spark, rows))
    assert calls
    assert silver(spark, refresh) == before
    store.merge_into_silver(
        spark, refresh.layout.silver, spark.createDataFrame([], schemas.SILVER)
    )
    assert silver(spark, refresh) == full(spark, refresh)


def test_merge_updates_measures_but_not_hour_end(spark, tmp_path):
    path = str(tmp_path / "silver")
    base = spark.sql(
        """select 'a' city, timestamp'2024-01-01 10:00:00' hour_start,
                  timestamp'2024-01-01 11:00:00' hour_end, 1.0D avg_temperature,
                  1.0D avg_humidity, 1.0D avg_windspeed, 1.0D max_temperature, 1L record_count"""
    )
    other_day = base.withColumn("hour_start", F.col("hour_start") + F.expr("INTERVAL 5 DAYS"))
    store.merge_into_silver(spark, path, base.unionByName(other_day))
    changed = base.withColumns(
        {"hour_end": F.lit(None).cast("timestamp"), "avg_temperature": F.lit(7.0)}
    )
    store.merge_into_silver(spark, path, changed)
    rows = store.read_silver(spark, path).orderBy("hour_start").collect()
    assert [r["avg_temperature"] for r in rows] == [7.0, 1.0]
    assert rows[0]["hour_end"] is not None


def test_cumulative_validation_equals_a_scan_of_the_table(spark, tmp_path, countries):
    """Counts of slices add up, also with failing checks and a repeated slice."""
    rows = [*observations(STAMPS, base=47.0), ("Paris", document("2024-02-02 00:00:00"))]
    refresh = job(
        tmp_path, countries, bronze_suite=bronze_suite(), silver_suite=silver_suite(),
        scope=CUMULATIVE,
    )
    for part in (rows[:48], rows[:48], rows[48:120], rows[120:]):
        summary = refresh.run(spark, payload_frame(spark, part))
        whole = validate(store.read_bronze(spark, refresh.layout), bronze_suite())
        assert summary.bronze_report.rows == whole.rows
        assert summary.bronze_report.statistics == whole.statistics
        assert summary.bronze_report.partial_lists == whole.partial_lists
        if summary.silver_report is not None:
            table = store.read_silver(spark, refresh.layout.silver)
            whole = validate(table, silver_suite())
            assert summary.silver_report.rows == whole.rows
            assert summary.silver_report.partial_lists == whole.partial_lists
    assert not summary.bronze_report.success
    assert len(reports.read_results(spark, refresh.layout.reports).select("layer").distinct().collect()) == 3

    changed = job(
        tmp_path, countries, bronze_suite=bronze_suite({"min_value": 1}), scope=CUMULATIVE
    )
    late = changed.run(spark, payload_frame(spark, [("Tokyo", document("2024-02-03 00:00:00"))]))
    whole = validate(store.read_bronze(spark, refresh.layout), changed.bronze_suite)
    assert late.bronze_report.rows == whole.rows


def test_cumulative_validation_never_scans_bronze(spark, tmp_path, countries, monkeypatch):
    def scan(*args, **kwargs):
        raise AssertionError("bronze was scanned")

    stored = store.as_stored
    monkeypatch.setattr(store, "read_bronze", scan)
    monkeypatch.setattr(store, "as_stored", lambda s, l, name="": stored(s, l, name) if name else scan())
    refresh = job(tmp_path, countries, bronze_suite=bronze_suite(), scope=CUMULATIVE)
    rows = observations(STAMPS[:6])
    for part in (rows[:12], rows[12:12], rows[12:]):
        summary = refresh.run(spark, payload_frame(spark, part))
    assert summary.bronze_report.rows[0]["observed_value"] == str(len(rows))


def test_increment_scope_checks_only_what_is_new(spark, tmp_path, countries):
    refresh = job(
        tmp_path, countries, bronze_suite=bronze_suite(), silver_suite=silver_suite(),
        scope=INCREMENT,
    )
    rows = observations(STAMPS)
    refresh.run(spark, payload_frame(spark, rows[:48]))
    second = refresh.run(spark, payload_frame(spark, rows[48:60]))
    assert second.bronze_report.rows[0]["observed_value"] == "12"
    assert second.silver_report.rows[1]["element_count"] == 6


def test_only_touched_dates_are_read(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    stamps = ("2024-01-05 10:00:00", "2024-01-06 10:00:00", "2024-03-05 10:00:00")
    for stamp in stamps:
        last = refresh.run(spark, payload_frame(spark, [("London", document(stamp))]))
    files = store.read_dates_of_slice(spark, refresh.layout, last.slice_name).inputFiles()
    assert files and all("event_date=2024-03-05/" in file for file in files)
    assert store.read_slice(spark, refresh.layout, "none").count() == 0


def test_gating_stops_before_silver_when_asked(spark, tmp_path, countries):
    refresh = job(
        tmp_path, countries, bronze_suite=bronze_suite({"min_value": 1000}), on_failure="raise"
    )
    with pytest.raises(ValidationFailed):
        refresh.run(spark, payload_frame(spark, observations(STAMPS[:2])))
    assert mark(spark, refresh) is None


def test_other_tracked_tables_keep_their_marks(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    store.write_mark(spark, refresh.layout, "other", "x", 0)
    refresh.run(spark, payload_frame(spark, observations(STAMPS[:1])))
    generation = store.latest_generation(spark, refresh.layout)
    assert store.read_mark(spark, refresh.layout, "other", generation) == "x"
    assert mark(spark, refresh) == "2024-01-30 20:35:00"
