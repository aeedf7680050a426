"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalars
from tidemark.operators import increment
from tidemark.operators.aggregate import (
    hourly_aggregate,
    only_touched,
    touched_hours,
    with_hour,
)
from tidemark.operators.enrich import dictionary_lookup
from tidemark.operators.suite import RESULTS, Suite, failures, statistics, validate
from tidemark.operators.upsert import ABSENT, upsert
from tidemark.plans import reports, store
from tidemark.plans.observations import (
    AS_OF,
    RENDERED,
    bronze,
    countries,
    inputs,
    offset_seconds,
    payloads,
    rendered,
    table,
)
from tidemark.plans.refresh import CUMULATIVE, INCREMENT, Refresh
from tidemark.plans.store import Layout
from tidemark.plans.suites import bronze_suite, silver_suite
from tidemark.shared import fresh_folder, small_frame, write_text
from tidemark.sources import runlog, tables
from tidemark.sources.payloads import typed_batch
from tidemark.streaming.refresh import read_payload_stream, start_refresh

CUT = "2024-01-20 00:00:00"
ORDERS_CUT = "1998-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    """Register under the function's name less ``_query``."""
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


def ntz(*names: str) -> dict:
    """Instants as zone-less UTC times, the type the given tables use."""
    return {name: scalars.utc(F.col(name)) for name in names}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


MEANS = {"avg_temperature": "value"}
MAXIMA = {"max_temperature": "value"}


def hourly_events(rows: DataFrame, **options) -> DataFrame:
    """Type and hour stand for city and hour. The given values have two decimals."""
    settings = {"entity": "event_type", "event_time": "ts", "means": MEANS, "maxima": MAXIMA}
    return hourly_aggregate(rows, **{**settings, "round_to": None, **options})


# --- sources and scalar functions ---------------------------------------------


@register
def json_extract(spark, sf_dir):
    return inputs(spark, sf_dir)


@register
def typed_batch_query(spark, sf_dir):
    documents = events(spark, sf_dir).select(F.to_json(F.struct("*")).alias("document"))
    declared = "event_type string, event_id bigint, value double, user_id bigint, note string"
    return typed_batch(documents, "document", declared)


@register
def epoch_to_string(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", scalars.epoch_to_string(F.unix_timestamp("ts")).alias("ts_text")
    )


@register
def utc_offset_label(spark, sf_dir):
    offset = offset_seconds()
    return events(spark, sf_dir).select(
        "event_id",
        offset.alias("offset_seconds"),
        scalars.utc_offset_label(offset).alias("label"),
    )


@register
def parse_event_time(spark, sf_dir):
    good = F.date_format("ts", scalars.TIMESTAMP_PATTERN)
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(good)
    return events(spark, sf_dir).select(
        "event_id", scalars.parse_event_time(text).cast("timestamp_ntz").alias("event_time")
    )


@register
def rename_drop(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .withColumns(
            {
                "o_orderstatus": F.lower("o_orderstatus"),
                "price_thousands": F.col("o_totalprice") / 1000,
            }
        )
        .drop("O_ORDERPRIORITY")
        .withColumnRenamed("o_totalprice", "total")
    )


@register
def partition_columns(spark, sf_dir):
    derived = scalars.year_month(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").withColumns(derived).select("o_orderkey", *derived)


def customer_countries(spark, sf_dir, default):
    """Codes go up to 26 and the dictionary to 24, so that some are not listed."""
    code = (F.col("c_custkey") % 27).cast("int").alias("code")
    customer = table(spark, sf_dir, "customer").select("c_custkey", code)
    names = table(spark, sf_dir, "nation")
    return dictionary_lookup(customer, "code", names, "n_nationkey", "n_name", "country", default)


@register
def dictionary_lookup_query(spark, sf_dir):
    return customer_countries(spark, sf_dir, "Unknown")


@register
def bronze_rows(spark, sf_dir):
    return bronze(spark, sf_dir).withColumns(ntz("event_time"))


# --- increments and the control table -------------------------------------------


def control_table(spark, sf_dir) -> DataFrame:
    """One mark per tracked table; that of ``events`` stands at the cut."""

    def row(name: str, rows: DataFrame, column: str) -> DataFrame:
        stamp = F.date_format(F.max(column), scalars.TIMESTAMP_PATTERN)
        return rows.agg(stamp.alias("WatermarkValue")).select(
            F.lit(name).alias("TableName"), "WatermarkValue"
        )

    before = increment.late_rows(events(spark, sf_dir), "ts", CUT)
    return (
        row("events", before, "ts")
        .unionByName(row("orders", table(spark, sf_dir, "orders"), "o_orderdate"))
        .unionByName(row("lineitem", table(spark, sf_dir, "lineitem"), "l_shipdate"))
    )


@register
def watermark_lookup(spark, sf_dir):
    return increment.mark_row(control_table(spark, sf_dir), "lineitem")


@register
def incremental_filter(spark, sf_dir):
    return increment.above_mark(events(spark, sf_dir), "ts", CUT)


@register
def initial_load(spark, sf_dir):
    """Two loads of the same table: the first finds no table, only what a write that never
    ended has left, and loads all it has; the second finds one and loads what is above."""
    path = fresh_folder(spark, "initial")
    rows = events(spark, sf_dir)
    write_text(spark, f"{path}/_temporary/0/left", "")
    for batch in (increment.late_rows(rows, "ts", CUT), rows):
        exists = tables.table_exists(spark, path)
        mark = tables.read_table(spark, path, rows.schema).agg(F.max("ts")).first()[0] if exists else None
        new = increment.above_mark(batch, "ts", mark)
        new.write.mode("append" if exists else "overwrite").parquet(path)
    return tables.read_table(spark, path, rows.schema)


@register
def watermark_advance(spark, sf_dir):
    """UPDATE of one control row with the newest time of the increment."""
    fresh = increment.above_mark(events(spark, sf_dir), "ts", CUT).select(
        F.date_format("ts", scalars.TIMESTAMP_PATTERN).alias("stamp")
    )
    mark = increment.next_mark(fresh, "stamp", F.lit(CUT)).scalar()
    return increment.update_control(control_table(spark, sf_dir), "events", mark)


@register
def late_rows(spark, sf_dir):
    late = increment.late_rows(events(spark, sf_dir), "ts", CUT)
    return late.groupBy("event_type").agg(F.count(F.lit(1)).alias("late_count"))


@register
def entity_increment(spark, sf_dir):
    """Each event type against a mark of its own."""
    rows = events(spark, sf_dir)
    marks = increment.entity_marks(
        increment.late_rows(rows, "ts", CUT), ["event_type"], "ts"
    )
    return increment.above_entity_marks(rows, marks, ["event_type"], "ts")


@register
def partitioned_append(spark, sf_dir):
    path = fresh_folder(spark, "append")
    orders = table(spark, sf_dir, "orders")
    dated = orders.withColumns(scalars.year_month(F.col("o_orderdate")))
    tables.append_partitioned(increment.late_rows(dated, "o_orderdate", ORDERS_CUT), path)
    tables.append_partitioned(increment.above_mark(dated, "o_orderdate", ORDERS_CUT), path)
    stored = tables.read_table(spark, path, dated.schema)
    cents = scalars.fixed_point(F.col("o_totalprice"), 2)
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(cents).alias("cents")
    )


# --- aggregates and upserts -------------------------------------------------------


@register
def hourly_aggregate_query(spark, sf_dir):
    return hourly_events(events(spark, sf_dir))


@register
def hourly_rounded(spark, sf_dir):
    return hourly_events(events(spark, sf_dir), round_to=2)


@register
def hourly_exact(spark, sf_dir):
    return hourly_events(events(spark, sf_dir), round_to=2, exact_digits=2)


@register
def silver_hourly(spark, sf_dir):
    """The eight silver columns from payloads, every step on the way included."""
    silver = hourly_aggregate(bronze(spark, sf_dir), exact_digits=2)
    return silver.withColumns(ntz("hour_start", "hour_end"))


@register
def silver_upsert(spark, sf_dir):
    """Hours before the 21st, merged with changed hours from the 20th on."""
    rows = events(spark, sf_dir)
    overlap = F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")
    start = F.lit(CUT).cast("timestamp_ntz")
    target = hourly_events(rows.filter(F.col("ts") < overlap), exact_digits=2)
    changed = rows.filter(F.col("ts") >= start).withColumn("value", F.col("value") + 1)
    source = hourly_events(changed, exact_digits=2)
    return upsert(
        target,
        source,
        keys=("event_type", "hour_start"),
        update_columns=("avg_temperature", "max_temperature", "record_count"),
        null_keys=ABSENT,
    )


@register
def silver_sorted(spark, sf_dir):
    silver = hourly_events(events(spark, sf_dir), exact_digits=2)
    return tables.latest_first(silver.withColumnRenamed("event_type", "city"), 20)


@register
def incremental_refresh(spark, sf_dir):
    """Only the hours the increment touches are aggregated again, then merged."""
    rows = events(spark, sf_dir)
    mark = "2024-01-20 00:30:00"
    silver = hourly_events(increment.late_rows(rows, "ts", mark), exact_digits=2)
    touched = touched_hours(increment.above_mark(rows, "ts", mark), "event_type", "ts")
    again = only_touched(hourly_events(rows, exact_digits=2), touched, "event_type")
    return upsert(
        silver,
        again,
        keys=("event_type", "hour_start"),
        update_columns=("avg_temperature", "max_temperature", "record_count"),
        null_keys=ABSENT,
    )


# --- expectations -------------------------------------------------------------------

VERDICT = ("expectation_type", "success")
COUNTS = ("element_count", "missing_count", "unexpected_count")
PERCENTAGES = (
    "missing_percent",
    "unexpected_percent",
    "unexpected_percent_total",
    "unexpected_percent_nonmissing",
)
TYPES = ["click", "view", "purchase"]
VALUE_RANGE = {"min_value": 0, "max_value": 50}
TWO_DIGITS = r'^\{"k": [0-9]{2}\}$'
STAMP_FORMAT = "%Y-%m-%d %H:%M:%S"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def stamped_events(spark, sf_dir) -> DataFrame:
    """Events with a text ``stamp``: impossible, missing and short dates included."""
    kind = F.col("event_type")
    stamp = (
        F.when(kind == "error", F.lit("2025-02-30 00:00:00"))
        .when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "click", F.lit("2025-1-1 0:0:0"))
        .otherwise(F.date_format("ts", scalars.TIMESTAMP_PATTERN))
    )
    return events(spark, sf_dir).withColumn("stamp", stamp)


@register
def expect_row_count(spark, sf_dir):
    suite = Suite().expect_table_row_count_to_be_between(1, 1000)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, "observed_value")


@register
def expect_column_count(spark, sf_dir):
    suite = Suite().expect_table_column_count_to_equal(6)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, "observed_value")


@register
def expect_columns_ordered(spark, sf_dir):
    suite = Suite().expect_table_columns_to_match_ordered_list(EVENT_COLUMNS)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, "observed_value")


@register
def expect_in_set(spark, sf_dir):
    suite = Suite().expect_column_values_to_be_in_set("event_type", TYPES)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, *COUNTS, *PERCENTAGES)


@register
def expect_not_null(spark, sf_dir):
    found = customer_countries(spark, sf_dir, None)
    suite = Suite().expect_column_values_to_not_be_null("country")
    return suite.evaluate(found).select(*VERDICT, *COUNTS, "unexpected_percent")


@register
def expect_column_exists(spark, sf_dir):
    suite = Suite().expect_column_to_exist("props").expect_column_to_exist("absent")
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, "column")


@register
def expect_between(spark, sf_dir):
    suite = Suite().expect_column_values_to_be_between("value", **VALUE_RANGE)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, *COUNTS, *PERCENTAGES)


@register
def expect_regex(spark, sf_dir):
    suite = Suite().expect_column_values_to_match_regex("props", TWO_DIGITS)
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, *COUNTS, *PERCENTAGES)


@register
def expect_type(spark, sf_dir):
    suite = Suite().expect_column_values_to_be_of_type("ts", "TimestampNTZType")
    suite = suite.expect_column_values_to_be_of_type("value", "LongType")
    return suite.evaluate(events(spark, sf_dir)).select(*VERDICT, "column", "observed_value")


@register
def expect_strftime(spark, sf_dir):
    suite = Suite().expect_column_values_to_match_strftime_format("stamp", STAMP_FORMAT)
    return suite.evaluate(stamped_events(spark, sf_dir)).select(*VERDICT, *COUNTS, *PERCENTAGES)


@register
def expect_compound_unique(spark, sf_dir):
    suite = Suite().expect_compound_columns_to_be_unique(["user_id", "event_type"])
    suite = suite.expect_compound_columns_to_be_unique(["event_id"])
    return suite.evaluate(events(spark, sf_dir)).select("seq", *VERDICT, *COUNTS)


SUITE_OUTPUT = (
    "seq", *VERDICT, "column", "observed_value", *COUNTS, "unexpected_percent", "raised_exception",
)


@register
def suite_bronze(spark, sf_dir):
    return bronze_suite().evaluate(bronze(spark, sf_dir)).select(*SUITE_OUTPUT)


@register
def suite_silver(spark, sf_dir):
    silver = hourly_aggregate(bronze(spark, sf_dir), exact_digits=2)
    return silver_suite().evaluate(silver).select(*SUITE_OUTPUT)


@register
def suite_stored_table(spark, sf_dir):
    """A stored table that lacks a column and has another instead: the files decide."""
    path = fresh_folder(spark, "stored")
    stored = events(spark, sf_dir).withColumn("note", F.lit("x")).drop("user_id")
    stored.write.parquet(path)
    suite = (
        Suite()
        .expect_table_column_count_to_equal(6)
        .expect_table_columns_to_match_ordered_list(EVENT_COLUMNS)
        .expect_column_to_exist("user_id")
        .expect_column_values_to_not_be_null("user_id")
        .expect_column_values_to_be_of_type("user_id", "LongType")
        .expect_column_to_exist("value")
        .expect_column_values_to_be_of_type("value", "DoubleType")
        .expect_column_values_to_not_be_null("value")
    )
    return suite.evaluate(spark.read.parquet(path)).select(*SUITE_OUTPUT)


def events_suite() -> Suite:
    return (
        Suite(name="events")
        .expect_table_row_count_to_be_between(1, 1000)
        .expect_column_values_to_be_in_set("event_type", TYPES)
        .expect_column_values_to_not_be_null("stamp")
        .expect_column_values_to_be_between("value", **VALUE_RANGE)
        .expect_column_values_to_match_regex("props", TWO_DIGITS)
        .expect_column_values_to_match_strftime_format("stamp", STAMP_FORMAT)
        .expect_column_values_to_not_be_null("absent")
        .expect_column_values_to_be_of_type("value", "DoubleType")
        .expect_compound_columns_to_be_unique(["user_id", "event_type"])
    )


def events_results(spark, sf_dir) -> DataFrame:
    return events_suite().evaluate(stamped_events(spark, sf_dir))


@register
def validation_results(spark, sf_dir):
    return events_results(spark, sf_dir).drop("kwargs", "exception_message")


@register
def validation_statistics(spark, sf_dir):
    return statistics(events_results(spark, sf_dir))


@register
def validation_failures(spark, sf_dir):
    return failures(events_results(spark, sf_dir)).select("seq", "expectation_type", "column")


LISTED = "seq int, place int, value string"


def listed(spark, lists: dict[int, list]) -> DataFrame:
    rows = [
        (seq, place, value if isinstance(value, str) else json.dumps(value))
        for seq, values in lists.items()
        for place, value in enumerate(values)
    ]
    return small_frame(spark, rows, schemas.flat(LISTED))


@register
def validation_offenders(spark, sf_dir):
    """The bounded lists of a report: the smallest unexpected values of each failed check."""
    report = validate(stamped_events(spark, sf_dir), events_suite(), "Events", "run-1")
    row_level = {
        row["seq"]: report.partial_lists[row["seq"]]
        for row in report.rows
        if row["column"] is not None and row["unexpected_count"]
    }
    return listed(spark, row_level)


@register
def validation_cumulative(spark, sf_dir):
    """Counts and lists of the bronze table after two runs, of which the second reads only
    its own slice."""
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "cumulative"), CUMULATIVE)
    report = [job.run(spark, batch) for batch in batches(spark, sf_dir, CUT)][-1].bronze_report
    results = small_frame(spark, report.rows, RESULTS)
    found = listed(spark, report.partial_lists).join(results, "seq")
    return found.select("expectation_type", "column", *COUNTS, "place", "value")


@register
def validation_report(spark, sf_dir):
    """A run written as tables and read back."""
    path = fresh_folder(spark, "reports")
    report = validate(stamped_events(spark, sf_dir), events_suite(), "Events", "run-1")
    reports.write_report(spark, report, path)
    return reports.read_runs(spark, path).drop("run_time")


@register
def validation_document(spark, sf_dir):
    """The JSON document of a run, written and parsed again, one row per result."""
    path = fresh_folder(spark, "reports")
    report = validate(stamped_events(spark, sf_dir), events_suite(), "Events", "run-1")
    reports.write_report(spark, report, path)
    schema = (
        "results array<struct<success: boolean, "
        "expectation_config: struct<expectation_type: string>, "
        "result: struct<element_count: bigint, missing_count: bigint, unexpected_count: bigint>>>"
    )
    parsed = reports.read_documents(spark, path).select(F.from_json("value", schema).alias("d"))
    return parsed.select(F.posexplode("d.results").alias("seq", "r")).select(
        "seq",
        "r.expectation_config.expectation_type",
        "r.success",
        "r.result.element_count",
        "r.result.missing_count",
        "r.result.unexpected_count",
    )


# --- run log ------------------------------------------------------------------------


def log_lines(spark, sf_dir) -> DataFrame:
    """Log lines written from events: errors as ERROR, everything else as INFO."""
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    message = F.concat(F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        runlog.render_line(F.col("ts"), level, message).alias("value"),
    )


def run_events(spark, sf_dir) -> DataFrame:
    return runlog.parse_lines(log_lines(spark, sf_dir))


@register
def runlog_parse(spark, sf_dir):
    return run_events(spark, sf_dir).withColumns(ntz("log_time"))


@register
def runlog_tail(spark, sf_dir):
    last = runlog.select_log(run_events(spark, sf_dir), "2024-01-15", "ERROR", tail=10)
    return last.select("seq", "level", "message")


@register
def runlog_days(spark, sf_dir):
    return runlog.log_days(run_events(spark, sf_dir))


# --- whole jobs ---------------------------------------------------------------------


def refresh_job(spark, sf_dir, folder: str, scope: str) -> Refresh:
    return Refresh(
        scope=scope,
        layout=Layout(folder),
        countries=countries(spark, sf_dir),
        bronze_suite=bronze_suite(),
        silver_suite=silver_suite(),
        exact_digits=2,
        as_of=AS_OF,
    )


def batches(spark, sf_dir, *cuts: str) -> list[DataFrame]:
    """The landed payloads in parts, up to each cut and after the last.

    Events lie in the order of their time, so a part is in a few places of the file: its
    events are dealt out before they are rendered and parsed.
    """
    happened = events(spark, sf_dir).select(*RENDERED)
    parts, low = [], None
    for cut in (*cuts, None):
        part = increment.above_mark(happened, "ts", low)
        parts.append((part if cut is None else increment.late_rows(part, "ts", cut)))
        low = cut
    return [rendered(part.hint("rebalance")).select("city", "payload") for part in parts]


class Stopping(Refresh):
    """A job that is stopped after silver and before its mark."""

    def _end(self, spark, summary):
        raise InterruptedError("stopped before the mark")


def interrupted_job(spark, sf_dir) -> Refresh:
    """Three runs over three batches, of which the second was stopped before its mark."""
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "interrupted"), CUMULATIVE)
    first, second, third = batches(spark, sf_dir, "2024-01-10 00:20:00", CUT)
    job.run(spark, first)
    with contextlib.suppress(InterruptedError):
        Stopping(**vars(job)).run(spark, second)
    job.run(spark, third)
    return job


@register
def end_to_end_refresh(spark, sf_dir):
    """Two scheduled runs from an empty root; silver holds the whole table."""
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "refresh"), CUMULATIVE)
    for batch in batches(spark, sf_dir, CUT):
        job.run(spark, batch)
    silver = store.read_silver(spark, job.layout.silver)
    return silver.withColumns(ntz("hour_start", "hour_end"))


@register
def interrupted_refresh(spark, sf_dir):
    """Silver after a run was stopped and the next batch came, beside the hours of bronze."""
    job = interrupted_job(spark, sf_dir)
    stored = with_hour(store.read_bronze(spark, job.layout), "event_time")
    stored = stored.groupBy("city", "hour_start").agg(F.count(F.lit(1)).alias("bronze_rows"))
    silver = store.read_silver(spark, job.layout.silver)
    joined = silver.join(stored, ["city", "hour_start"], "full")
    return joined.withColumns(ntz("hour_start", "hour_end"))


@register
def runlog_events(spark, sf_dir):
    """What those runs logged, less the names of their slices."""
    job = interrupted_job(spark, sf_dir)
    message = F.regexp_replace("message", "run-[0-9]+-[0-9a-f]+", "of a run")
    logged = runlog.read_events(spark, job.layout.runlog)
    return logged.select("level", message.alias("message"))


@register
def quarantine(spark, sf_dir):
    """Payloads that were rejected, as they came, and why."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    broken = events(spark, sf_dir).filter(kind.isin("error", "view")).select(
        F.when(kind == "error", F.lit("Sydney")).alias("city"),
        F.concat(F.lit("no document, "), number).alias("payload"),
    )
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "quarantine"), INCREMENT)
    for batch in batches(spark, sf_dir, CUT):
        job.run(spark, batch.unionByName(broken))
    return store.read_rejected(spark, job.layout).drop("slice")


def land(spark, batch: DataFrame, path: str) -> None:
    batch.select("payload", "city").write.partitionBy("city").mode("append").text(path)


def streamed(spark, job: Refresh, folder: str, **options) -> None:
    stream = read_payload_stream(spark, f"{folder}/landed", max_files_per_trigger=1000)
    start_refresh(job, stream, f"{folder}/checkpoint", **options).awaitTermination()


@register
def streaming_refresh(spark, sf_dir):
    """The same silver table from a stream over landed files."""
    folder = fresh_folder(spark, "stream")
    land(spark, payloads(spark, sf_dir), f"{folder}/landed")
    job = refresh_job(spark, sf_dir, f"{folder}/tables", INCREMENT)
    streamed(spark, job, folder)
    silver = store.read_silver(spark, job.layout.silver)
    return silver.withColumns(ntz("hour_start", "hour_end"))


@register
def streaming_late(spark, sf_dir):
    """A stream that starts with the middle of the table and drops late rows from its second
    batch on; a scheduled run on the same root in between has a mark of its own."""
    folder = fresh_folder(spark, "late")
    early, middle, last = batches(spark, sf_dir, "2024-01-10 00:20:00", CUT)
    job = refresh_job(spark, sf_dir, f"{folder}/tables", INCREMENT)
    land(spark, middle, f"{folder}/landed")
    streamed(spark, job, folder)
    job.run(spark, last)
    land(spark, early.unionByName(last), f"{folder}/landed")
    streamed(spark, job, folder, drop_late=True)
    silver = store.read_silver(spark, job.layout.silver)
    return silver.withColumns(ntz("hour_start", "hour_end"))
