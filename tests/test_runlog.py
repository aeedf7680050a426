from datetime import datetime, timezone

import pytest

from tidemark.sources import runlog


def test_append_and_select(spark, tmp_path):
    path = str(tmp_path / "log")
    assert runlog.read_events(spark, path).count() == 0
    day1 = datetime(2025, 11, 6, 23, 59, 59, tzinfo=timezone.utc)
    day2 = datetime(2025, 11, 7, 0, 0, 1, tzinfo=timezone.utc)
    runlog.append_events(spark, path, [("INFO", "one"), ("ERROR", "two")], day1)
    runlog.append_events(spark, path, [("INFO", "saw [ERROR] before"), ("INFO", "four")], day2)
    events = runlog.read_events(spark, path)
    assert [str(r[0]) for r in runlog.log_days(events).collect()] == ["2025-11-06", "2025-11-07"]

    def messages(**chosen):
        return [r["message"] for r in runlog.select_log(events, **chosen).collect()]

    assert messages(date="2025-11-06") == ["one", "two"]
    assert messages(date="2025-11-06", level="ERROR") == ["two"]
    assert messages(date="2025-11-07", level="ERROR") == ["saw [ERROR] before"]
    assert messages(date="2025-11-07", tail=1) == ["four"]
    assert messages(date="2025-11-07", tail=5) == ["saw [ERROR] before", "four"]
    assert messages(date="2025-01-01") == []
    with pytest.raises(ValueError):
        runlog.append_events(spark, path, [("DEBUG", "x")])


def test_today_is_the_default(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append_events(spark, path, [("INFO", "now")])
    assert runlog.select_log(runlog.read_events(spark, path)).count() == 1


def test_text_lines_round_trip(spark, tmp_path):
    file = tmp_path / "log_2025-11-06.txt"
    file.write_text(
        "[2025-11-06 10:00:00] [INFO] started\n"
        "[2025-11-06 10:00:01] [ERROR] failed: [x] y\n"
        "no such form\n"
    )
    rows = runlog.read_text_log(spark, str(file)).orderBy("seq").collect()
    assert [(r["level"], r["message"]) for r in rows] == [
        ("INFO", "started"),
        ("ERROR", "failed: [x] y"),
        (None, None),
    ]
    assert rows[1]["log_time"] == datetime(2025, 11, 6, 10, 0, 1)
    assert rows[2]["log_time"] is None and rows[2]["log_date"] is None
    parsed = runlog.read_text_log(spark, str(file)).filter("level is not null")
    line = runlog.render_line(parsed["log_time"], parsed["level"], parsed["message"])
    assert [r[0] for r in parsed.orderBy("seq").select(line).collect()] == (
        file.read_text().splitlines()[:2]
    )


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    for day in ("06", "07"):
        lines = [
            f"[2025-11-{day} 10:{n // 60:02d}:{n % 60:02d}] [{'ERROR' if n % 50 == 0 else 'INFO'}] line {n}"
            for n in range(900)
        ]
        lines[5] = "a trace below line 4"
        (tmp_path / f"log_2025-11-{day}.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    try:
        log = runlog.read_text_log(spark, str(tmp_path)).collect()
        last = runlog.tail_lines(runlog.read_text_log(spark, str(tmp_path)), 20, "ERROR").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(log) == 1800
    for row in log:
        if row["message"] is not None:
            assert row["message"] == f"line {row['seq'] - 1}"
        else:
            assert row["seq"] == 6 and row["value"] == "a trace below line 4"
    assert [(r["file"][-6:-4], r["message"]) for r in last] == [
        *[("06", f"line {n}") for n in range(800, 900, 50)],
        *[("07", f"line {n}") for n in range(0, 900, 50)],
    ]
