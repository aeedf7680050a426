import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from helpers import document, hours_after, payload_frame, plan_of
from tidemark import schemas
from tidemark.operators import expectations as ex
from tidemark.operators.enrich import to_bronze
from tidemark.operators.expectations import Expectation
from tidemark.operators.suite import (
    Suite,
    ValidationFailed,
    build_suite,
    failures,
    offenders,
    statistics,
    validate,
)
from tidemark.operators.aggregate import hourly_aggregate
from tidemark.plans import reports
from tidemark.plans.suites import CITIES, bronze_suite, silver_suite
from tidemark.sources.payloads import flatten_payloads

SCHEMA = "name string, size int, amount double, stamp string"


def frame(spark):
    rows = [
        ("a", 1, 0.0, "2025-01-01 00:00:00"),
        ("b", 2, 50.0, "2025-02-30 00:00:00"),
        ("b", 2, 50.1, "2025-1-1 0:0:0"),
        (None, None, None, None),
        ("é\n", None, float("nan"), "2025-01-01 00:00:00\n"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def results(spark, suite):
    return [row.asDict() for row in suite.evaluate(frame(spark)).orderBy("seq").collect()]


def counts(row):
    return row["success"], row["element_count"], row["missing_count"], row["unexpected_count"]


def test_row_count_bounds_are_inclusive(spark):
    suite = Suite()
    for low, high in ((5, 5), (1, 4), (6, None), (None, 5), (None, None)):
        suite = suite.expect_table_row_count_to_be_between(low, high)
    rows = results(spark, suite)
    assert [r["success"] for r in rows] == [True, False, False, True, True]
    assert {r["observed_value"] for r in rows} == {"5"}


def test_schema_checks(spark):
    names = ["name", "size", "amount", "stamp"]
    suite = (
        Suite()
        .expect_table_column_count_to_equal(4)
        .expect_table_column_count_to_equal(5)
        .expect_table_columns_to_match_ordered_list(names)
        .expect_table_columns_to_match_ordered_list(names[::-1])
        .expect_table_columns_to_match_ordered_list([n.upper() for n in names])
        .expect_column_to_exist("size")
        .expect_column_values_to_be_of_type("size", "IntegerType")
        .expect_column_values_to_be_of_type("size", "LongType")
        .expect_column_to_exist("absent")
    )
    rows = results(spark, suite)
    assert [r["success"] for r in rows] == [
        True, False, True, False, False, True, True, False, False,
    ]
    assert rows[0]["observed_value"] == "4"
    assert json.loads(rows[2]["observed_value"]) == names
    assert rows[5]["observed_value"] is None
    assert rows[7]["observed_value"] == "IntegerType"
    assert all(r["unexpected_count"] is None for r in rows)


def test_value_checks_skip_nulls(spark):
    suite = (
        Suite()
        .expect_column_values_to_be_in_set("name", ["a", "b"])
        .expect_column_values_to_not_be_null("name")
        .expect_column_values_to_be_between("amount", 0, 50)
        .expect_column_values_to_be_between("size", 1, None)
        .expect_column_values_to_match_regex("name", "^[ab]$")
        .expect_column_values_to_match_strftime_format("stamp", "%Y-%m-%d %H:%M:%S")
    )
    rows = {r["expectation_type"] + ":" + r["column"]: r for r in results(spark, suite)}
    assert counts(rows[f"{ex.IN_SET}:name"]) == (False, 5, 1, 1)
    assert counts(rows[f"{ex.NOT_NULL}:name"]) == (False, 5, None, 1)
    assert counts(rows[f"{ex.BETWEEN}:amount"]) == (False, 5, 1, 2)
    assert counts(rows[f"{ex.BETWEEN}:size"]) == (True, 5, 2, 0)
    assert counts(rows[f"{ex.REGEX}:name"]) == (False, 5, 1, 1)
    assert counts(rows[f"{ex.STRFTIME}:stamp"]) == (False, 5, 1, 2)


def test_percentages(spark):
    suite = Suite().expect_column_values_to_be_in_set("name", ["a"])
    suite = suite.expect_column_values_to_not_be_null("size")
    inside, missing = results(spark, suite)
    assert inside["missing_percent"] == 20.0
    assert inside["unexpected_percent"] == inside["unexpected_percent_nonmissing"] == 75.0
    assert inside["unexpected_percent_total"] == 60.0
    assert missing["missing_percent"] is None
    assert missing["unexpected_percent"] == missing["unexpected_percent_total"] == 40.0
    assert missing["unexpected_percent_nonmissing"] is None


def test_counts_add_up(spark):
    suite = Suite().expect_column_values_to_be_between("amount", 0, 50)
    row = results(spark, suite)[0]
    expected = frame(spark).filter("amount between 0 and 50").count()
    assert row["element_count"] == row["missing_count"] + expected + row["unexpected_count"]


def test_empty_table(spark):
    empty = frame(spark).filter(F.lit(False))
    suite = (
        Suite()
        .expect_column_values_to_not_be_null("name")
        .expect_column_values_to_be_in_set("name", ["a"])
        .expect_compound_columns_to_be_unique(["name", "size"])
    )
    for row in suite.evaluate(empty).collect():
        assert row["success"] and row["element_count"] == 0
        assert row["unexpected_percent"] is None and row["missing_percent"] is None


def test_compound_unique(spark):
    suite = (
        Suite()
        .expect_compound_columns_to_be_unique(["name", "size"])
        .expect_compound_columns_to_be_unique(["name", "stamp"])
        .expect_compound_columns_to_be_unique(["size"])
    )
    rows = results(spark, suite)
    assert [counts(r) for r in rows] == [
        (False, 5, 1, 2),
        (True, 5, 1, 0),
        (False, 5, 2, 2),
    ]


def test_one_hot_repeated_key_is_counted_whole(spark):
    df = spark.range(30_000).select((F.col("id") % 3 * F.col("id")).alias("k"))
    expected = df.groupBy("k").count().filter("count > 1").agg(F.sum("count")).first()[0]
    row = Suite().expect_compound_columns_to_be_unique(["k"]).evaluate(df).first()
    assert row["unexpected_count"] == expected > 10_000


def test_null_in_a_value_set_hides_nothing(spark):
    suite = Suite().expect_column_values_to_be_in_set("name", ["a", None])
    suite = suite.expect_column_values_to_be_in_set("name", [])
    suite = suite.plus("expect_something_else")
    unknown, listed, empty = results(spark, suite)
    assert counts(listed) == (False, 5, 1, 3)
    assert counts(empty) == (False, 5, 1, 4)
    assert unknown["raised_exception"] and not unknown["success"]


def test_a_failing_check_does_not_stop_the_others(spark):
    suite = (
        Suite()
        .expect_column_values_to_not_be_null("absent")
        .expect_column_values_to_be_in_set("name", ["a", "b"])
        .expect_column_values_to_match_strftime_format("size", "%Y")
        .expect_column_values_to_match_strftime_format("stamp", "%Q")
        .expect_compound_columns_to_be_unique(["name", "absent"])
    )
    rows = results(spark, suite)
    assert [r["raised_exception"] for r in rows] == [True, True, False, True, True]
    assert not any(r["success"] for r in rows)
    assert all(r["exception_message"] for r in rows if r["raised_exception"])
    assert rows[2]["unexpected_count"] == 1


def test_values_that_cannot_be_compared_are_unexpected(spark):
    suite = (
        Suite()
        .expect_column_values_to_not_be_null("name")
        .expect_column_values_to_match_regex("name", "(unclosed")
        .expect_column_values_to_be_between("stamp", 0, 1)
        .expect_column_values_to_be_between("size", 0, 10)
        .expect_column_values_to_be_between("size", "0", "x")
        .expect_column_values_to_be_in_set("stamp", [1, 2.5])
    )
    report = validate(frame(spark), suite)
    assert [r["raised_exception"] for r in report.rows] == [False, True, False, False, False, False]
    counts = {(r["column"], r["seq"]): r["unexpected_count"] for r in report.rows}
    assert counts == {("name", 0): 1, ("name", 1): None, ("stamp", 2): 4, ("stamp", 3): 4,
                      ("size", 4): 0, ("size", 5): 3}


def test_an_error_of_the_engine_is_no_verdict(spark, tmp_path):
    suite = Suite().expect_column_values_to_not_be_null("v").expect_column_to_exist("v")
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("row"))).alias("v"))
    with pytest.raises(Exception, match="row"):
        validate(bad, suite)
    path = tmp_path / "damaged"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    with pytest.raises(Exception):  # noqa: B017, PT011
        validate(spark.read.schema("v string").parquet(str(path)), suite)


def test_order_is_table_first_then_by_first_named_column(spark):
    suite = (
        Suite()
        .expect_column_values_to_not_be_null("size")
        .expect_column_values_to_not_be_null("name")
        .expect_column_to_exist("size")
        .expect_table_column_count_to_equal(4)
        .expect_column_to_exist("name")
    )
    assert [(r["column"], r["expectation_type"]) for r in results(spark, suite)] == [
        (None, ex.COLUMN_COUNT),
        ("size", ex.NOT_NULL),
        ("size", ex.EXISTS),
        ("name", ex.NOT_NULL),
        ("name", ex.EXISTS),
    ]


def test_wide_suites_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).select(
        *[F.when(F.col("id") % (n + 2) > 0, F.col("id")).alias(f"c{n}") for n in range(60)]
    ).write.parquet(path)
    df = spark.read.parquet(path)
    suite = build_suite(
        not_null=df.columns,
        ranges={c: {"min_value": 0, "max_value": 50} for c in df.columns},
        unique=[["c0", "c1"], ["c2"]],
    )
    evaluated = suite.evaluate(df)
    assert plan_of(evaluated).count("FileScan") == 1
    rows = {(r["expectation_type"], r["column"]): r for r in evaluated.collect()}
    assert len(rows) == 121
    for n in range(60):
        missing = sum(i % (n + 2) == 0 for i in range(100))
        above = sum(i % (n + 2) > 0 and i > 50 for i in range(100))
        assert rows[ex.NOT_NULL, f"c{n}"]["unexpected_count"] == missing
        assert rows[ex.BETWEEN, f"c{n}"]["unexpected_count"] == above


def test_schema_checks_run_no_job(spark, tmp_path):
    df = spark.range(10).select(F.raise_error(F.lit("computed")).alias("v"))
    suite = Suite().expect_column_to_exist("v").expect_table_column_count_to_equal(1)
    evaluated = suite.expect_column_values_to_be_of_type("v", "NullType").evaluate(df)
    assert "LocalTableScan" in plan_of(evaluated) and "Range" not in plan_of(evaluated)
    assert [r["success"] for r in evaluated.orderBy("seq").collect()] == [True, True, True]


def test_results_by_group(spark):
    df = frame(spark).withColumn("part", F.coalesce("size", F.lit(9)) % 2)
    suite = (
        Suite()
        .expect_column_values_to_be_between("amount", 0, 50)
        .expect_table_row_count_to_be_between(2, 9)
        .expect_compound_columns_to_be_unique(["name", "size"])
        .expect_column_to_exist("part")
    )
    by = suite.evaluate_by(df, "part").drop("part").collect()
    each = [suite.evaluate(df.filter(f"part = {n}").drop("part")).collect() for n in (0, 1)]
    assert sorted(map(str, by)) == sorted(str(row) for rows in each for row in rows)


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1,), (None,)], "`a.b` int")
    row = Suite().expect_column_values_to_not_be_null("a.b").evaluate(df).first()
    assert row["unexpected_count"] == 1


def test_offenders_and_partial_lists(spark):
    df = spark.range(1000)
    rule = Expectation(ex.BETWEEN, {"column": "id", "min_value": 0, "max_value": 9})
    assert offenders(df, rule).count() == 990
    suite = Suite().expect_column_values_to_be_between("id", 0, 9)
    suite = suite.expect_column_values_to_be_between("id", 0, 999)
    report = validate(df, suite)
    assert report.partial_lists == {0: list(range(10, 30))}


def test_lists_are_the_smallest_of_every_failed_check(spark):
    df = spark.range(0, 600, 1, 7).select(
        "id", F.concat(F.lit("t"), F.col("id") % 40).alias("t"), (F.col("id") / 2).alias("half"),
        F.when(F.col("id") % 100 > 0, F.col("id")).alias("gap"),
    )
    suite = (
        Suite()
        .expect_column_values_to_be_between("half", 0, 100)
        .expect_column_values_to_match_regex("t", "^t[0-3]")
        .expect_column_values_to_not_be_null("gap")
        .expect_compound_columns_to_be_unique(["t"])
        .expect_compound_columns_to_be_unique(["id"])
    )
    report = validate(df, suite)
    lists = {r["expectation_type"] + r["kwargs"]: report.partial_lists.get(r["seq"]) for r in report.rows}
    by_kind = {(k.split("{")[0], k): v for k, v in lists.items()}
    found = {k[0]: v for k, v in by_kind.items() if "id" not in k[1]}
    assert found[ex.BETWEEN] == [100.5 + n / 2 for n in range(20)]
    assert found[ex.REGEX] == ["t4"] * 15 + ["t5"] * 5
    assert found[ex.NOT_NULL] == [None] * 6
    assert found[ex.COMPOUND_UNIQUE] == [{"t": f"t{n}"} for n in sorted(map(str, range(40)))[:20]]
    assert [v for k, v in lists.items() if '"id"' in k] == [None]


def test_statistics_and_failures(spark):
    suite = Suite().expect_column_to_exist("name").expect_column_to_exist("absent")
    evaluated = suite.evaluate(frame(spark))
    assert tuple(statistics(evaluated).first()) == (2, 1, 1, 50.0)
    assert [r["column"] for r in failures(evaluated).collect()] == ["absent"]
    nothing = Suite().evaluate(frame(spark))
    assert tuple(statistics(nothing).first()) == (0, 0, 0, None)
    assert validate(frame(spark), Suite()).statistics["success_percent"] is None


def test_gating_is_opt_in(spark):
    suite = Suite().expect_column_to_exist("absent")
    assert not validate(frame(spark), suite).success
    with pytest.raises(ValidationFailed):
        validate(frame(spark), suite, on_failure="raise")


@pytest.fixture(scope="module")
def golden_bronze(spark, countries):
    rows = []
    for city, offset, country in zip(
        CITIES, (0, -18000, 32400, 36000, 19800), ("GB", "US", "JP", "AU", "IN"), strict=True
    ):
        for stamp in hours_after("2025-12-20 00:10:00", 34):
            rows.append((city, document(stamp, offset=offset, country=country)))
    inputs = flatten_payloads(payload_frame(spark, rows[:168]), "2025-12-23 05:00:00")
    return to_bronze(inputs, countries).cache()


def test_bronze_suite_has_the_recorded_shape(spark, golden_bronze):
    report = validate(
        golden_bronze, bronze_suite(), "Bronze", "r1", datetime(2025, 12, 23, tzinfo=timezone.utc)
    )
    written = report.to_json_dict()
    assert written["success"] is True
    assert written["statistics"] == {
        "evaluated_expectations": 47,
        "successful_expectations": 47,
        "unsuccessful_expectations": 0,
        "success_percent": 100.0,
    }
    assert set(written) == {"success", "results", "evaluation_parameters", "statistics", "meta"}
    entries = written["results"]
    assert entries[0]["result"] == {"observed_value": 168}
    assert entries[1]["result"] == {"observed_value": 14}
    assert entries[2]["result"] == {"observed_value": schemas.BRONZE.names}
    assert entries[3] == {
        "success": True,
        "expectation_config": {
            "expectation_type": ex.IN_SET,
            "kwargs": {"column": "city", "value_set": CITIES, "result_format": "BASIC"},
            "meta": {},
        },
        "result": {
            "element_count": 168,
            "missing_count": 0,
            "missing_percent": 0.0,
            "unexpected_count": 0,
            "unexpected_percent": 0.0,
            "unexpected_percent_total": 0.0,
            "unexpected_percent_nonmissing": 0.0,
            "partial_unexpected_list": [],
        },
        "meta": {},
        "exception_info": {
            "raised_exception": False,
            "exception_message": None,
            "exception_traceback": None,
        },
    }
    assert list(entries[4]["result"]) == [
        "element_count",
        "unexpected_count",
        "unexpected_percent",
        "unexpected_percent_total",
        "partial_unexpected_list",
    ]
    assert entries[5]["result"] == {}
    assert entries[6]["result"] == {"observed_value": "StringType"}
    kinds = [
        (e["expectation_config"]["expectation_type"], e["expectation_config"]["kwargs"].get("column"))
        for e in entries
    ]
    per_column = {}
    for kind, column in kinds:
        per_column.setdefault(column, []).append(kind)
    assert list(per_column) == [None, *schemas.BRONZE.names[:12]]
    assert per_column["temperature"] == [ex.NOT_NULL, ex.EXISTS, ex.BETWEEN, ex.OF_TYPE]
    assert per_column["load_time"] == [ex.NOT_NULL, ex.EXISTS, ex.REGEX, ex.OF_TYPE, ex.STRFTIME]
    assert per_column["timeZone"] == [ex.NOT_NULL, ex.EXISTS, ex.REGEX, ex.OF_TYPE]
    assert json.loads(json.dumps(written, default=str)) == written


def test_silver_suite_has_28_checks(spark, golden_bronze):
    report = validate(hourly_aggregate(golden_bronze), silver_suite(), "Silver")
    assert report.success and len(report.rows) == 28
    assert sum(r["expectation_type"] == ex.COMPOUND_UNIQUE for r in report.rows) == 2


def test_reports_keep_every_run_and_replace_a_repeated_one(spark, tmp_path):
    path = str(tmp_path / "reports")
    bad = Suite().expect_column_to_exist("absent").expect_column_values_to_not_be_null("size")
    first = validate(frame(spark), bad, "Bronze", "run-1")
    second = validate(frame(spark), Suite().expect_column_to_exist("name"), "Bronze", "run:2")
    for report in (first, second, first):
        reports.write_report(spark, report, path)
    runs = {r["run_id"]: r for r in reports.read_runs(spark, path).collect()}
    assert set(runs) == {"run-1", "run-2"}
    assert runs["run-1"]["unsuccessful_expectations"] == 2
    assert runs["run-2"]["success_percent"] == 100.0
    failed = reports.read_failures(spark, path).orderBy("seq").collect()
    assert [r["expectation_type"] for r in failed] == [ex.EXISTS, ex.NOT_NULL]
    stored = reports.read_results(spark, path).filter("run_id = 'run-1' and seq = 1").first()
    assert stored["partial_unexpected_list"] == [None, None]
    summaries = {r["run_id"]: r["summary"] for r in reports.read_summaries(spark, path).collect()}
    assert summaries["run-1"].splitlines()[2:] == [
        "0 of 2 passed, 2 failed (0.0%)",
        f"- {ex.EXISTS}",
        f"- {ex.NOT_NULL}",
    ]
    assert summaries["run-2"].endswith("no check failed")
    assert second.statistics == {
        "evaluated_expectations": 1, "successful_expectations": 1,
        "unsuccessful_expectations": 0, "success_percent": 100.0,
    }
    documents = [json.loads(r["value"]) for r in reports.read_documents(spark, path).collect()]
    assert sorted(d["success"] for d in documents) == [False, True]
