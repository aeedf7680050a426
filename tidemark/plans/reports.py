"""Validation outcomes as tables, one partition per run and layer.

Writing a run again replaces it; other runs stay. The human summary of a run,
its statistics and its failed checks, are views over the stored results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import utc
from tidemark.operators.expectations import COMPOUND_UNIQUE
from tidemark.operators.suite import (
    RESULTS,
    Suite,
    ValidationReport,
    combine,
    failures,
    list_of,
    merge_lists,
    partial_lists,
    statistics_columns,
    validate,
)
from tidemark.plans.keyindex import merged_texts
from tidemark.shared import child_names, is_complete, small_frame, write_text
from tidemark.version import __version__

STORED = (
    T.StructType(list(RESULTS.fields))
    .add("partial_unexpected_list", T.ArrayType(T.StringType()))
    .add("suite_name", "string")
    .add("run_time", "timestamp")
    .add("validation_time", "timestamp")
    .add("version", "string")
)


def results_frame(spark: SparkSession, report: ValidationReport) -> DataFrame:
    """The rows of a report, one per expectation, with the run they belong to."""
    about = (report.suite_name, report.run_time, report.validation_time, __version__)
    rows = [
        (*row, _encoded(report.partial_lists.get(row["seq"], [])), *about) for row in report.rows
    ]
    return small_frame(spark, rows, STORED)


def _encoded(values: list) -> list:
    """Unexpected values as JSON texts, a missing one as NULL."""
    return [None if v is None else json.dumps(v, default=str) for v in values]


def _decoded(values: list) -> list:
    return [None if v is None else json.loads(v) for v in values]


def _safe(text: str) -> str:
    """A value that needs no escaping in a partition folder."""
    return "".join(c if c.isalnum() or c in "-_" else "-" for c in text)


def _folder(path: str, run_id: str, layer: str, kind: str = "validation_results") -> str:
    return f"{path}/{kind}/run_id={_safe(run_id)}/layer={_safe(layer)}"


def write_report(spark: SparkSession, report: ValidationReport, path: str) -> None:
    """Store the results of one run, and the same run as one JSON document."""
    results = results_frame(spark, report).coalesce(1)
    results.write.mode("overwrite").parquet(_folder(path, report.run_id, report.layer))
    document = json.dumps(report.to_json_dict(), default=str)
    target = _folder(path, report.run_id, report.layer, "documents")
    write_text(spark, f"{target}/document.json", document + "\n")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(list(STORED.fields)).add("run_id", "string").add("layer", "string")
    return spark.read.schema(schema).parquet(f"{path}/validation_results")


def combined_report(
    spark: SparkSession,
    path: str,
    newest: ValidationReport,
    previous_run: str | None,
    suite: Suite,
    layer: str,
    keys: Mapping[int, tuple[int, list]] | None = None,
) -> ValidationReport | None:
    """The report on a table that grew by one slice, without scanning the table.

    Counts of the previous run's report on the table and of ``newest``, the
    report on the slice, add up. Rows with repeated keys do not; ``keys`` has, by the ``seq``
    of such checks, by how much they have grown and the keys that are repeated now. None when
    there is no such report, or it was made with another suite, or ``keys`` lacks a check.
    """
    keys = keys or {}
    compound = {n for n, e in enumerate(suite.ordered()) if e.expectation_type == COMPOUND_UNIQUE}
    if previous_run is None or not compound <= keys.keys():
        return None
    folder = _folder(path, previous_run, layer)
    if not is_complete(spark, folder):
        return None
    before = spark.read.schema(STORED).parquet(folder)
    stored = before.select("seq", "kwargs", "expectation_type", "partial_unexpected_list").collect()
    checks = {(row["seq"], row["kwargs"], row["expectation_type"]) for row in newest.rows}
    if {tuple(row)[:3] for row in stored} != checks:
        return None
    lists: dict[int, list[list]] = {
        row["seq"]: [_decoded(row["partial_unexpected_list"])] for row in stored
    }
    for seq, values in newest.partial_lists.items():
        if seq not in keys:
            lists[seq].append(values)
    for seq, (_, values) in keys.items():
        lists[seq] = [merged_texts(*lists[seq], values)]
    added = [_grown(row, keys[row["seq"]][0]) if row["seq"] in keys else row for row in newest.rows]
    parts = before.select(*RESULTS.names).unionByName(small_frame(spark, added, RESULTS))
    parts = parts.coalesce(1)  # as few rows as a suite has checks, twice
    return _report_of(combine(parts), lists, suite, layer, newest.run_id, newest.run_time)


def _with_whole_keys(
    each: list[ValidationReport], parts: list[DataFrame], suite: Suite, layer: str, run_id: str
) -> list[ValidationReport]:
    """Reports on parts, of which the last has all repeated keys of the table and the others
    none. A check that some part has no columns for stays as it is."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    whole = validate(together, suite, layer, run_id)
    broken = {row["seq"] for report in each for row in report.rows if row["raised_exception"]}
    keyed = {
        n for n, e in enumerate(suite.ordered()) if e.expectation_type == COMPOUND_UNIQUE
    } - broken
    found = {row["seq"]: row["unexpected_count"] for row in whole.rows}
    for report in each:
        last = report is each[-1]
        report.rows = [
            Row(*RESULTS.names)(*_grown(row, found[row["seq"]] if last else 0))
            if row["seq"] in keyed
            else row
            for row in report.rows
        ]
        for seq in keyed:
            report.partial_lists.pop(seq, None)
            if last and seq in whole.partial_lists:
                report.partial_lists[seq] = whole.partial_lists[seq]
    return each


def _grown(row: Row, grown: int) -> tuple:
    """The result of a compound check on a slice, as what the slice adds to the table's."""
    if row["raised_exception"]:
        return tuple(row)
    added = {**row.asDict(), "unexpected_count": grown, "success": grown == 0}
    return tuple(added[name] for name in RESULTS.names)


def validate_parts(
    parts: list[DataFrame], suite: Suite, layer: str, run_id: str, keys_apart: bool = False
) -> ValidationReport:
    """The report on a table that is stored in parts with schemas of their own: a check of the
    schema holds if it holds for every part, counts add up. Compound checks see all parts
    together, unless it is known that no key is in two of them (``keys_apart``)."""
    each = [validate(part, suite, layer, run_id) for part in parts]
    if len(each) == 1:
        return each[0]
    if not keys_apart and not suite.is_additive():
        each = _with_whole_keys(each, parts, suite, layer, run_id)
    spark = parts[0].sparkSession
    results = small_frame(spark, [row for report in each for row in report.rows], RESULTS)
    results = results.coalesce(1)
    lists: dict[int, list[list]] = {}
    for report in each:
        for seq, values in report.partial_lists.items():
            lists.setdefault(seq, []).append(values)
    return _report_of(combine(results), lists, suite, layer, run_id, each[0].run_time)


def _report_of(
    combined: DataFrame,
    lists: dict[int, list[list]],
    suite: Suite,
    layer: str,
    run_id: str,
    run_time: datetime,
) -> ValidationReport:
    rows = sorted(combined.collect(), key=lambda row: row["seq"])
    merged = {
        row["seq"]: merge_lists(lists.get(row["seq"], [])) for row in rows if row["unexpected_count"]
    }
    return ValidationReport(rows, merged, suite.name, layer, run_id, run_time)


# --- results by part of a table -------------------------------------------------


def _parts_folder(path: str, suite: Suite) -> str:
    """Parts belong to the very checks that made them."""
    checks = json.dumps([[e.expectation_type, e.kwargs_json] for e in suite.ordered()])
    return f"{path}/parts/suite={hashlib.sha256(checks.encode()).hexdigest()[:16]}"


def known_parts(spark: SparkSession, path: str, suite: Suite) -> set[str]:
    """Folder names, ``group=value``, of the parts whose results are stored."""
    return {name for name in child_names(spark, _parts_folder(path, suite)) if "=" in name}


def write_parts(
    spark: SparkSession, rows: DataFrame, group: str, suite: Suite, path: str
) -> None:
    """Store the results of a suite for each value of ``group`` in ``rows``, replacing the
    stored results of just those. They are as many as parts times checks."""
    expectations = suite.ordered()
    results: list[Row] = suite.evaluate_by(rows, group).collect()
    wrong = [row for row in results if row["unexpected_count"]]
    failed = [(seq, expectations[seq]) for seq in sorted({row["seq"] for row in wrong})]
    lists = partial_lists(rows, failed, group=group)
    now = datetime.now(timezone.utc)
    stored = []
    for row in results:
        part = str(row[group])
        own = _encoded(list_of(row, lists, part)) if row["unexpected_count"] else []
        values = [row[name] for name in RESULTS.names]
        stored.append((*values, own, suite.name, now, now, __version__, part))
    if not stored:
        return
    (
        small_frame(spark, stored, T.StructType(list(STORED.fields)).add(group, "string"))
        .repartition(group)
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(group)
        .mode("overwrite")
        .parquet(_parts_folder(path, suite))
    )


def report_of_parts(
    spark: SparkSession, path: str, suite: Suite, layer: str, run_id: str
) -> ValidationReport:
    """The report on a whole table from the stored results of its parts. No key of a
    compound check may be in two parts."""
    parts = spark.read.schema(STORED).parquet(_parts_folder(path, suite))
    lists: dict[int, list[list]] = {}
    for row in parts.filter("unexpected_count > 0").select("seq", "partial_unexpected_list").collect():
        lists.setdefault(row["seq"], []).append(_decoded(row["partial_unexpected_list"]))
    combined = combine(parts.select(*RESULTS.names))
    return _report_of(combined, lists, suite, layer, run_id, datetime.now(timezone.utc))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Statistics per run and layer."""
    grouped = read_results(spark, path).groupBy("run_id", "layer", "suite_name", "run_time")
    return grouped.agg(*statistics_columns())


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """The failed checks of every run."""
    return failures(read_results(spark, path)).select(
        "run_id", "layer", "run_time", "seq", "expectation_type", "column"
    )


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Every run as text: heading, time, statistics and a list of failed checks.

    The list is as long as a suite at most.
    """
    failed = F.filter(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seq", "success", "expectation_type"))),
            lambda check: F.when(~check["success"], F.concat(F.lit("- "), check["expectation_type"])),
        ),
        lambda line: line.isNotNull(),
    )
    grouped = read_results(spark, path).groupBy("run_id", "layer", "run_time")
    runs = grouped.agg(*statistics_columns(), failed.alias("failed"))
    none = F.lit("no check failed")
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("checks of "), "layer"),
        F.concat(F.lit("at "), utc(F.col("run_time")).cast("string")),
        F.concat(
            F.col("successful_expectations").cast("string"),
            F.lit(" of "),
            F.col("evaluated_expectations").cast("string"),
            F.lit(" passed, "),
            F.col("unsuccessful_expectations").cast("string"),
            F.lit(" failed ("),
            F.col("success_percent").cast("string"),
            F.lit("%)"),
        ),
        F.when(F.size("failed") == 0, none).otherwise(F.array_join("failed", "\n")),
    )
    return runs.select("run_id", "layer", "run_time", lines.alias("summary"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(f"{path}/documents")
