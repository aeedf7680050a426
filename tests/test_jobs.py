"""The job with several checkpoints, marks by city, landed files, names and versions."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import document, payload_frame, sorted_rows
from test_refresh import CITIES, STAMPS, full, job, observations, silver
from test_streaming import land, run_stream
from tidemark import schemas
from tidemark.operators.suite import Suite, validate
from tidemark.plans import catalog, store
from tidemark.plans.jobs import without_column
from tidemark.plans.refresh import CUMULATIVE, INCREMENT
from tidemark.plans.suites import bronze_suite, silver_suite
from tidemark.shared import child_names, delete_path
from tidemark.streaming.refresh import (
    APPEND,
    UnknownCheckpoint,
    process_batch,
    read_payload_stream,
    start_refresh,
)

# --- checkpoints ---------------------------------------------------------------------


def stream_from(spark, refresh, folder, checkpoint, **options):
    stream = read_payload_stream(spark, str(folder), 3)
    query = start_refresh(refresh, stream, str(checkpoint), **options)
    query.awaitTermination()


def test_a_new_checkpoint_never_removes_what_an_earlier_one_stored(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS)
    for number, part in enumerate((rows[:120], rows[120:])):
        land(tmp_path / f"landed{number}", "part", part)
    stream_from(spark, refresh, tmp_path / "landed0", tmp_path / "first")
    before = store.read_bronze(spark, refresh.layout).count()
    with pytest.raises(Exception, match="known from checkpoint"):
        stream_from(spark, refresh, tmp_path / "landed1", tmp_path / "second")
    assert store.read_bronze(spark, refresh.layout).count() == before == 120
    stream_from(spark, refresh, tmp_path / "landed1", tmp_path / "second", new_checkpoint=APPEND)
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)
    assert silver(spark, refresh) == full(spark, refresh)


def test_batches_of_two_checkpoints_are_told_apart(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    parts = [observations(STAMPS[n : n + 1]) for n in range(4)]
    options = {"drop_late": True, "new_checkpoint": APPEND}
    process_batch(refresh, payload_frame(spark, parts[0]), 5, checkpoint="a", **options)
    process_batch(refresh, payload_frame(spark, parts[1]), 0, checkpoint="b", **options)
    for _ in range(2):  # a replay of the newest batch of each
        process_batch(refresh, payload_frame(spark, parts[1]), 0, checkpoint="b", **options)
        process_batch(refresh, payload_frame(spark, parts[0]), 5, checkpoint="a", **options)
    process_batch(refresh, payload_frame(spark, parts[3]), 1, checkpoint="b", **options)
    process_batch(refresh, payload_frame(spark, parts[2]), 6, checkpoint="a", **options)
    kept = {r[0][:13] for r in store.read_bronze(spark, refresh.layout).select("timestamp").collect()}
    assert kept == {STAMPS[n][:13] for n in (0, 1, 3)}  # the mark belongs to the source
    with pytest.raises(UnknownCheckpoint):
        process_batch(refresh, payload_frame(spark, parts[3]), 0, checkpoint="c")
    assert silver(spark, refresh) == full(spark, refresh)


# --- marks by city ---------------------------------------------------------------------


def late_city(slow="Mumbai"):
    quick = [city for city in CITIES if city != slow]
    first = observations(STAMPS[:6], quick)
    second = observations(STAMPS[:6], [slow]) + observations(STAMPS[6:9], quick) + first[:4]
    third = observations(STAMPS[6:9], [slow])
    return [first, second, third], observations(STAMPS[:9], CITIES)


def keys(spark, refresh):
    stored = store.read_bronze(spark, refresh.layout).select("city", "timestamp")
    return sorted(map(tuple, stored.collect()))


def expected_keys(rows):
    return sorted((c, s) for c, s in {(c, _stamp(p)) for c, p in rows})


def _stamp(payload):
    from datetime import datetime, timezone

    moment = datetime.fromtimestamp(json.loads(payload)["dt"], timezone.utc)
    return moment.strftime("%Y-%m-%d %H:%M:%S")


def test_a_slow_city_loses_nothing(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, entity_marks=True)
    parts, everything = late_city()
    late = [refresh.run(spark, payload_frame(spark, part)).late_rows for part in parts]
    assert late == [0, 4, 0]
    assert keys(spark, refresh) == expected_keys(everything)
    assert silver(spark, refresh) == full(spark, refresh)


def test_the_same_as_a_stream_with_replays(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, entity_marks=True)
    parts, everything = late_city()
    for number, part in enumerate(parts):
        for _ in range(2):
            process_batch(refresh, payload_frame(spark, part), number, drop_late=True, checkpoint="c")
    assert keys(spark, refresh) == expected_keys(everything)
    assert silver(spark, refresh) == full(spark, refresh)


def test_marks_by_city_may_begin_on_a_table_that_had_one_mark(spark, tmp_path, countries):
    parts, _ = late_city()
    job(tmp_path, countries).run(spark, payload_frame(spark, parts[0]))
    refresh = job(tmp_path, countries, entity_marks=True)
    again = refresh.run(spark, payload_frame(spark, parts[0] + parts[1]))
    assert again.late_rows == len(parts[0]) + 4
    refresh.run(spark, payload_frame(spark, parts[2]))
    assert keys(spark, refresh) == expected_keys(sum(parts, []))


@pytest.mark.parametrize("step", ["write_entity_marks", "stage_updates", "write_mark", "forget_pending"])
def test_a_stopped_run_keeps_marks_by_city(spark, tmp_path, countries, monkeypatch, step):
    refresh = job(tmp_path, countries, entity_marks=True)
    parts, everything = late_city()
    refresh.run(spark, payload_frame(spark, parts[0]))

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, step, stop)
        with pytest.raises(RuntimeError):
            refresh.run(spark, payload_frame(spark, parts[1]))
    refresh.run(spark, payload_frame(spark, parts[2]))
    assert keys(spark, refresh) == expected_keys(everything)
    assert silver(spark, refresh) == full(spark, refresh)


def test_few_marks_are_kept(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, entity_marks=True)
    for n in range(7):
        refresh.run(spark, payload_frame(spark, observations(STAMPS[n : n + 1])))
    assert len(child_names(spark, f"{refresh.layout.state}/entity_marks")) == store.KEPT_MARKS


# --- values of the wrong type ------------------------------------------------------------


def reasons(spark, refresh):
    found = store.read_rejected(spark, refresh.layout).select("payload", "reason").collect()
    return {r["payload"]: r["reason"] for r in found}


def test_values_of_the_wrong_type_are_found_and_kept(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, bronze_suite=bronze_suite(), scope=CUMULATIVE)
    good = document("2024-01-01 10:00:00")
    base = json.loads(good)
    faulty = {
        "wrong type: main.temp": {**base, "main": {"temp": "abc", "humidity": 5}},
        "wrong type: main.humidity": {**base, "main": {"temp": 1, "humidity": 5.5}},
        "wrong type: main": {**base, "main": 7},
        "wrong type: wind.speed": {**base, "wind": {"speed": [1]}},
        "wrong type: weather": {**base, "weather": "rain"},
        "wrong type: dt": {**base, "dt": "noon"},
        "wrong type: timezone, sys": {**base, "timezone": "x", "sys": "x"},
        "no event time": {**base, "dt": None},
    }
    fine = [
        {**base, "dt": base["dt"] + 60, "main": {"temp": 3, "humidity": None}},
        {**base, "dt": base["dt"] + 61, "weather": [], "extra": {"a": 1}, "sys": {}},
        {k: v for k, v in {**base, "dt": base["dt"] + 62}.items() if k != "wind"},
        {**base, "dt": base["dt"] + 63, "weather": [{"description": 5}]},
    ]
    texts = {why: json.dumps(value) for why, value in faulty.items()}
    rows = [("London", good), *[("London", json.dumps(v)) for v in fine]]
    rows += [("London", text) for text in texts.values()] + [("London", "broken"), (None, texts["wrong type: main"] + " ")]
    summary = refresh.run(spark, payload_frame(spark, rows))
    found = reasons(spark, refresh)
    for why, text in texts.items():
        assert sorted(found[text].removeprefix("wrong type: ").split(", ")) == sorted(
            why.removeprefix("wrong type: ").split(", ")
        )
    assert found["broken"] == "no event time"
    assert found[texts["wrong type: main"] + " "] == "no city"
    assert (summary.accepted_rows, summary.rejected_rows) == (5, len(texts) + 2)


# --- landed files ----------------------------------------------------------------------


def test_each_landed_file_is_taken_once(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, entity_marks=True)
    rows = observations(STAMPS)
    landed = tmp_path / "landed"
    land(landed, "a[1]{x}*?", rows[:60])
    assert refresh.run_landed(spark, str(landed)).accepted_rows == 60
    land(landed, "b", rows[60:])
    assert refresh.run_landed(spark, str(landed)).accepted_rows == len(rows) - 60
    again = refresh.run_landed(spark, str(landed))
    assert (again.accepted_rows, again.late_rows) == (0, 0)
    ledger = store.read_landed(spark, refresh.layout)
    assert ledger.count() == ledger.select("path").distinct().count() == 2 * len(CITIES)
    assert silver(spark, refresh) == full(spark, refresh)


def test_what_is_more_than_a_run_takes_waits(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, entity_marks=True)
    rows = observations(STAMPS[:8])
    for n in range(4):
        land(tmp_path / "landed", f"part{n}", rows[n * 12 : (n + 1) * 12])
    taken = [refresh.run_landed(spark, str(tmp_path / "landed"), 5).accepted_rows for _ in range(4)]
    assert sum(taken) == len(rows) and taken[-1] == 0 and all(taken[:3])


@pytest.mark.parametrize("step", ["write_slice", "stage_updates", "write_mark"])
def test_files_of_a_stopped_run_are_neither_lost_nor_taken_twice(
    spark, tmp_path, countries, monkeypatch, step
):
    refresh = job(tmp_path, countries)
    rows = observations(STAMPS)
    landed = tmp_path / "landed"
    land(landed, "a", rows[:60])

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, step, stop)
        with pytest.raises(RuntimeError):
            refresh.run_landed(spark, str(landed))
    land(landed, "b", rows[60:])
    refresh.run_landed(spark, str(landed))
    assert store.read_bronze(spark, refresh.layout).count() == len(rows)
    assert silver(spark, refresh) == full(spark, refresh)


# --- names and versions ------------------------------------------------------------------


def test_tables_by_name_follow_every_run(spark, tmp_path, countries):
    name = "weather_db"
    refresh = job(tmp_path, countries, catalog=name, bronze_suite=bronze_suite(), scope=CUMULATIVE)
    try:
        assert not catalog.table_exists(spark, name, catalog.SILVER)
        rows = observations(STAMPS)
        for part in (rows[:48], rows[48:50], rows[50:], rows[:2]):
            refresh.run(spark, payload_frame(spark, part))
            for table in (catalog.BRONZE, catalog.SILVER, catalog.CONTROL):
                assert catalog.table_exists(spark, name, table)
            assert sorted_rows(catalog.read_table(spark, name, catalog.SILVER)) == silver(spark, refresh)
            stored = store.read_bronze(spark, refresh.layout)
            assert sorted_rows(catalog.read_table(spark, name, catalog.BRONZE)) == sorted_rows(stored)
        mark = spark.sql(f"select WatermarkValue from `{name}`.control where TableName = 'weather_data'")
        assert mark.first()[0] == "2024-02-01 11:35:00"
        dates = spark.sql(f"select count(distinct hour_date) from `{name}`.silver").first()[0]
        assert dates == len(store.snapshot(spark, refresh.layout.silver).dates)
        catalog.unregister(spark, name)
        catalog.register(spark, refresh.layout, name)
        assert sorted_rows(catalog.read_table(spark, name, catalog.SILVER)) == silver(spark, refresh)
    finally:
        catalog.unregister(spark, name)
    assert silver(spark, refresh) == full(spark, refresh)


def test_streams_are_registered_too(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, catalog="streamed")
    land(tmp_path / "landed", "a", observations(STAMPS[:5]))
    try:
        run_stream(spark, refresh, tmp_path)
        assert sorted_rows(catalog.read_table(spark, "streamed", catalog.SILVER)) == silver(spark, refresh)
    finally:
        catalog.unregister(spark, "streamed")


def test_a_reader_sees_one_version_whole(spark, tmp_path, countries, monkeypatch):
    refresh = job(tmp_path, countries)
    path, rows = refresh.layout.silver, observations(STAMPS)
    refresh.run(spark, payload_frame(spark, rows[:100]))
    old = silver(spark, refresh)
    reader = store.read_silver(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            refresh.run(spark, payload_frame(spark, rows))
    assert silver(spark, refresh) == old  # all dates are written, none of them is read
    refresh.run(spark, payload_frame(spark, rows))
    assert sorted_rows(reader) == old != silver(spark, refresh)
    assert sorted_rows(store.read_silver(spark, path, version=1)) == old
    with pytest.raises(ValueError, match="not kept"):
        store.read_silver(spark, path, version=99)


def test_old_versions_go_and_untouched_dates_stay(spark, tmp_path, countries):
    refresh = job(tmp_path, countries)
    path = refresh.layout.silver
    refresh.run(spark, payload_frame(spark, [("London", document("2024-01-01 10:00:00"))]))
    for n in range(6):
        refresh.run(spark, payload_frame(spark, observations(STAMPS[n * 2 : n * 2 + 2])))
    assert store._snapshot_numbers(spark, path) == [5, 6, 7]
    first = store.snapshot(spark, path).dates["hour_date=2024-01-01"]
    assert first.startswith("version=0000000001-")
    assert len(child_names(spark, f"{path}/hour_date=2024-01-30")) <= store.KEPT_VERSIONS
    assert silver(spark, refresh) == full(spark, refresh)


# --- checks of stored files ---------------------------------------------------------------


def failed(report):
    return {(r["expectation_type"], r["column"]) for r in report.rows if not r["success"]}


def lacking(column, *others):
    kinds = ["column_to_exist", "column_values_to_not_be_null", "column_values_to_be_of_type", *others]
    return {(f"expect_{kind}", column) for kind in kinds}


def test_silver_files_without_a_column_fail_just_its_checks(spark, tmp_path, countries):
    refresh = job(tmp_path, countries, silver_suite=silver_suite(), bronze_suite=bronze_suite())
    rows = observations(STAMPS)
    refresh.run(spark, payload_frame(spark, rows[:100]))
    folders = store.snapshot(spark, refresh.layout.silver).folders(refresh.layout.silver)
    without_column(spark, folders[:1], "max_temperature")
    report = refresh.run(spark, payload_frame(spark, rows[220:])).silver_report
    ordered = {("expect_table_columns_to_match_ordered_list", None)}
    assert failed(report) == ordered | lacking("max_temperature", "column_values_to_be_between")
    assert report.rows[1]["element_count"] == store.read_silver(spark, refresh.layout.silver).count()


def test_one_bronze_slice_without_a_column_fails_whatever_file_comes_first(
    spark, tmp_path, countries
):
    refresh = job(tmp_path, countries, bronze_suite=bronze_suite())
    rows = observations(STAMPS)
    for place in (0, 1, 2):
        own = job(tmp_path / str(place), countries, bronze_suite=bronze_suite())
        names = [own.run(spark, payload_frame(spark, rows[n * 40 : n * 40 + 40])).slice_name for n in range(3)]
        without_column(spark, store.slice_folders(spark, own.layout, names[place])[:1], "humidity")
        report = own.run(spark, payload_frame(spark, rows[120:])).bronze_report
        assert failed(report) == lacking("humidity") | {
            ("expect_table_columns_to_match_ordered_list", None),
            ("expect_table_column_count_to_equal", None),
        }
    assert refresh.run(spark, payload_frame(spark, rows[:40])).bronze_report.success


def test_staged_updates_are_checked_as_they_are_stored(spark, tmp_path, countries, monkeypatch):
    refresh = job(tmp_path, countries, silver_suite=silver_suite(), scope=INCREMENT)
    stage = store.stage_updates

    def losing(spark_, path, source):
        stage(spark_, path, source)
        dates = [f"{path}_updates/{d}" for d in child_names(spark, f"{path}_updates") if "=" in d]
        without_column(spark, dates, "avg_humidity")

    monkeypatch.setattr(store, "stage_updates", losing)
    report = refresh.run(spark, payload_frame(spark, observations(STAMPS[:4]))).silver_report
    assert lacking("avg_humidity") <= failed(report)


def test_types_that_differ_between_slices(spark, tmp_path, countries):
    suite = Suite().expect_column_values_to_be_of_type("humidity", "IntegerType")
    refresh = job(tmp_path, countries, bronze_suite=suite)
    first = refresh.run(spark, payload_frame(spark, observations(STAMPS[:2])))
    assert first.bronze_report.success
    folder = store.slice_folders(spark, refresh.layout, first.slice_name)[0]
    changed = spark.read.parquet(folder).withColumn("humidity", F.col("humidity").cast("string"))
    changed.write.parquet(f"{tmp_path}/changed")
    delete_path(spark, folder)
    spark.read.parquet(f"{tmp_path}/changed").write.parquet(folder)
    again = refresh.run(spark, payload_frame(spark, observations(STAMPS[4:6]))).bronze_report
    assert not again.success and again.rows[0]["observed_value"] == "StringType"


def test_keys_repeated_between_slices_of_different_schemas(spark, tmp_path, countries):
    suite = Suite().expect_compound_columns_to_be_unique(["humidity", "city"])
    suite = suite.expect_column_to_exist("windspeed")
    refresh = job(tmp_path, countries, bronze_suite=suite)
    first = refresh.run(spark, payload_frame(spark, observations(STAMPS[:2])))
    without_column(spark, store.slice_folders(spark, refresh.layout, first.slice_name)[:1], "windspeed")
    report = refresh.run(spark, payload_frame(spark, observations(STAMPS[2:6]))).bronze_report
    whole = validate(store.read_bronze(spark, refresh.layout), suite)
    assert report.rows[0] == whole.rows[0] and report.partial_lists == whole.partial_lists
    assert failed(report) == {(r["expectation_type"], r["column"]) for r in report.rows}


def test_an_empty_silver_table_is_checked_as_declared(spark, tmp_path):
    (part,) = store.silver_parts(spark, str(tmp_path / "nothing"))
    assert part.schema == schemas.SILVER and part.count() == 0
