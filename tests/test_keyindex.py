"""The index of keys against counting all rows."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import document, payload_frame, plan_of
from test_refresh import STAMPS, job, observations
from tidemark.operators.suite import Suite, validate
from tidemark.plans import store
from tidemark.plans.keyindex import KeyIndex, merged_texts
from tidemark.plans.refresh import CUMULATIVE

COLUMNS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, c string")


def counted(slices):
    keys = Counter((a, b) for rows in slices for a, b, _ in rows if (a, b) != (None, None))
    return sum(n for n in keys.values() if n > 1)


SLICES = [
    [("x", 1, ""), ("x", 2, ""), ("y", 1, ""), (None, None, "")],
    [("x", 1, ""), ("z", 1, ""), ("z", 1, ""), (None, 5, "")],
    [("x", 1, ""), (None, 5, ""), ("w", None, ""), (None, None, "")],
    [],
    [("w", None, ""), ("q", 0, "")],
]


def test_slices_add_up(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "keys"), COLUMNS, buckets=4)
    total = 0
    for number, rows in enumerate(SLICES):
        grown, texts = index.add(frame(spark, rows), f"s{number}")
        total += grown
        assert total == counted(SLICES[: number + 1]) == index.repeated(spark)
        repeated = {json.dumps(dict(zip(COLUMNS, (a, b), strict=True)), separators=(",", ":")) for a, b, _ in rows}
        assert set(texts) <= repeated
    again, _ = index.add(frame(spark, SLICES[-1]), "s4")
    assert again == 2 and index.repeated(spark) == counted(SLICES)


def test_runs_are_merged_by_levels_and_old_files_go(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "keys"), COLUMNS, buckets=2, fan=3)
    rows = [[(f"k{n % 7}", n % 3, ""), ("always", 0, "")] for n in range(14)]
    total = sum(index.add(frame(spark, own), f"s{n}")[0] for n, own in enumerate(rows))
    assert total == counted(rows) == index.repeated(spark)
    runs = index.runs(spark)
    assert max(run.level for run in runs) >= 1 and len(runs) < 10
    folders = {p.name for p in (tmp_path / "keys").iterdir() if p.name.startswith("run=")}
    assert folders == {f"run={run.name}" for run in runs}


def test_a_slice_meets_only_its_buckets(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "keys"), COLUMNS, buckets=64)
    index.add(frame(spark, [(f"k{n}", n, "") for n in range(300)]), "s0")
    own = index.keys_of(frame(spark, [("k5", 5, "")]))
    bucket = own.first()["bucket"]
    files = index._read(spark, index.runs(spark), {f"bucket={bucket}"}).inputFiles()
    assert files and all(f"bucket={bucket}/" in f for f in files)


def test_lists_keep_each_key_once():
    assert merged_texts([{"a": 2}, {"a": 1}], [{"a": 1}]) == [{"a": 1}, {"a": 2}]
    assert len(merged_texts([{"a": n} for n in range(50)])) == 20


@pytest.fixture
def keyed():
    suite = Suite(name="keys").expect_compound_columns_to_be_unique(["city", "timestamp"])
    return suite.expect_compound_columns_to_be_unique(["humidity", "city"]).expect_column_to_exist("city")


def test_cumulative_checks_of_keys_equal_a_scan(spark, tmp_path, countries, keyed, monkeypatch):
    refresh = job(tmp_path, countries, bronze_suite=keyed, scope=CUMULATIVE)
    rows = observations(STAMPS)
    twice = [("London", document("2024-02-03 00:00:00", humidity=77))] * 2
    parts = [rows[:48], rows[:48], rows[48:120], twice, rows[120:]]
    for number, part in enumerate(parts):
        if number == 2:  # from now on the table must not be read
            monkeypatch.setattr(store, "stored_parts", None)
            monkeypatch.setattr(store, "read_other_slices", None)
        summary = refresh.run(spark, payload_frame(spark, part))
        whole = validate(store.read_bronze(spark, refresh.layout), keyed)
        assert summary.bronze_report.rows == whole.rows
        assert summary.bronze_report.partial_lists == whole.partial_lists
    assert not summary.bronze_report.success


def test_an_index_begun_late_knows_the_earlier_slices(spark, tmp_path, countries, keyed):
    rows = observations(STAMPS)
    job(tmp_path, countries).run(spark, payload_frame(spark, rows[:48]))
    refresh = job(tmp_path, countries, bronze_suite=keyed, scope=CUMULATIVE)
    for part in (rows[48:96], rows[96:]):
        summary = refresh.run(spark, payload_frame(spark, part))
        whole = validate(store.read_bronze(spark, refresh.layout), keyed)
        assert summary.bronze_report.rows == whole.rows


def test_a_slice_is_compared_without_scanning_the_table(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "keys"), COLUMNS)
    index.add(frame(spark, SLICES[0]), "s0")
    own = index.keys_of(frame(spark, SLICES[1]))
    stored = index._read(spark, index.runs(spark), {f"bucket={r['bucket']}" for r in own.collect()})
    plan = plan_of(own.join(stored.groupBy("bucket", "high", "low").agg(F.sum("rows")), ["bucket", "high", "low"], "left"))
    assert "PartitionFilters" in plan and "BroadcastNestedLoopJoin" not in plan
