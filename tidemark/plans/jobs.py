"""Registered queries that run the job in ways of its own: other checkpoints, marks by city,
landed files, names of a catalog, older versions, and tables that others have changed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalars
from tidemark.operators import expectations as ex
from tidemark.operators import increment
from tidemark.operators.aggregate import with_hour
from tidemark.operators.exactsum import hourly_reproducible as reproducible_hours
from tidemark.operators.suite import Suite
from tidemark.plans import catalog, reports, store
from tidemark.plans.observations import AS_OF, CITY_OF, bronze, countries, payloads
from tidemark.plans.queries import (
    CUT,
    MAXIMA,
    MEANS,
    Query,
    batches,
    events,
    land,
    listed,
    log_lines,
    ntz,
    refresh_job,
    run_events,
    streamed,
)
from tidemark.plans.refresh import CUMULATIVE, INCREMENT, TABLE, Refresh
from tidemark.plans.store import Layout
from tidemark.plans.suites import bronze_suite, silver_suite
from tidemark.shared import delete_path, fresh_folder, move_path, small_frame
from tidemark.sources import runlog
from tidemark.sources.payloads import flatten_payloads
from tidemark.streaming.refresh import APPEND, read_payload_stream
from tidemark.streaming.stateful import read_hours, run_stateful

QUERIES: dict[str, Query] = {}
EARLY = "2024-01-10 00:20:00"
SLOW_CITY = "Sydney"


def register(query: Callable) -> Callable:
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


def silver_of(spark: SparkSession, job: Refresh) -> DataFrame:
    silver = store.read_silver(spark, job.layout.silver)
    return silver.withColumns(ntz("hour_start", "hour_end"))


def beside_bronze(spark: SparkSession, job: Refresh) -> DataFrame:
    """Silver, and how many rows bronze holds for each of its hours."""
    stored = with_hour(store.read_bronze(spark, job.layout), "event_time")
    stored = stored.groupBy("city", "hour_start").agg(F.count(F.lit(1)).alias("bronze_rows"))
    silver = store.read_silver(spark, job.layout.silver)
    joined = silver.join(stored, ["city", "hour_start"], "full")
    return joined.withColumns(ntz("hour_start", "hour_end"))


# --- streams ------------------------------------------------------------------------


@register
def streaming_two_checkpoints(spark, sf_dir):
    """One source whose second half comes from another folder, with a new checkpoint."""
    folder = fresh_folder(spark, "checkpoints")
    job = refresh_job(spark, sf_dir, f"{folder}/tables", INCREMENT)
    for number, batch in enumerate(batches(spark, sf_dir, CUT)):
        land(spark, batch, f"{folder}/{number}/landed")
        streamed(spark, job, f"{folder}/{number}", new_checkpoint=APPEND)
    return beside_bronze(spark, job)


def in_disorder(spark, sf_dir, *cuts: str) -> list[DataFrame]:
    """The landed payloads in parts, of which one user in seven is a part late."""
    landed = payloads(spark, sf_dir)
    slow = F.get_json_object("payload", "$.timezone").cast("bigint") % 7 == 0
    parts, low = [], None
    for cut in (*cuts, None):
        part = increment.above_mark(landed, "ts", low)
        parts.append(part if cut is None else increment.late_rows(part, "ts", cut))
        low = cut
    late = [part.filter(slow) for part in parts[:-1]]
    parts = [part.filter(~slow) for part in parts[:-1]] + parts[-1:]
    return [parts[0], *[a.unionByName(b) for a, b in zip(parts[1:], late, strict=True)]]


@register
def stateful_hourly(spark, sf_dir):
    """Hours put out by a stream that keeps them in its state and is run three times; the delay
    covers the disorder."""
    folder = fresh_folder(spark, "stateful")
    for part in in_disorder(spark, sf_dir, EARLY, CUT):
        land(spark, part, f"{folder}/landed")
        stream = read_payload_stream(spark, f"{folder}/landed", max_files_per_trigger=1000)
        inputs = flatten_payloads(stream, AS_OF)
        rows = inputs.select(
            "city",
            scalars.parse_event_time(F.col("timestamp")).alias("event_time"),
            "temperature",
            "humidity",
            "windspeed",
        )
        run_stateful(spark, rows, f"{folder}/hours", f"{folder}/checkpoint", "10 days")
    return read_hours(spark, f"{folder}/hours").withColumns(ntz("hour_start", "hour_end"))


# --- marks, faults, landed files --------------------------------------------------------


@register
def entity_refresh(spark, sf_dir):
    """Marks by city: the slow city always comes a batch late and all others come twice."""
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "entities"), INCREMENT)
    job = Refresh(**{**vars(job), "entity_marks": True})
    parts = batches(spark, sf_dir, EARLY, CUT)
    slow = F.col("city") == SLOW_CITY
    job.run(spark, parts[0].filter(~slow))
    job.run(spark, parts[1].filter(~slow).unionByName(parts[0]))
    job.run(spark, parts[2].unionByName(parts[1]).unionByName(parts[0].filter(~slow)))
    return beside_bronze(spark, job)


#: What a document of some event types has instead of a number or an object.
FAULTY = {
    "view": ('{"temp":"abc","humidity":40}', '{"speed":1.5}', "wrong type: main.temp"),
    "click": ('{"temp":3.5,"humidity":4.5}', '"calm"', "wrong type: main.humidity, wind"),
    "error": ("[1]", '{"speed":true}', "wrong type: main, wind.speed"),
}


@register
def quarantine_faults(spark, sf_dir):
    """Documents with values of the wrong type, as they came, and which values those are."""
    kind, seconds = F.col("event_type"), F.unix_timestamp("ts").cast("string")

    def chosen(place: int):
        value = F.lit(None).cast("string")
        for event_type, parts in FAULTY.items():
            value = F.when(kind == event_type, F.lit(parts[place])).otherwise(value)
        return value

    city = F.lit(None).cast("string")
    for event_type in FAULTY:
        city = F.when(kind == event_type, F.lit(CITY_OF[event_type])).otherwise(city)
    faulty = events(spark, sf_dir).filter(kind.isin(*FAULTY)).select(
        city.alias("city"),
        F.concat(
            F.lit('{"main":'), chosen(0), F.lit(',"dt":'), seconds,
            F.lit(',"wind":'), chosen(1), F.lit(',"weather":[],"sys":{},"timezone":null}'),
        ).alias("payload"),
    )
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "faults"), INCREMENT)
    job.run(spark, batches(spark, sf_dir)[0].unionByName(faulty))
    return store.read_rejected(spark, job.layout).drop("slice")


@register
def landed_once(spark, sf_dir):
    """Three runs over one folder, of which the second finds the files that came meanwhile and
    the third nothing."""
    folder = fresh_folder(spark, "landing")
    job = refresh_job(spark, sf_dir, f"{folder}/tables", INCREMENT)
    for batch in batches(spark, sf_dir, CUT):
        land(spark, batch, f"{folder}/landed")
        job.run_landed(spark, f"{folder}/landed")
    job.run_landed(spark, f"{folder}/landed")
    return beside_bronze(spark, job)


# --- names and versions --------------------------------------------------------------------


@register
def catalog_refresh(spark, sf_dir):
    """Two runs whose tables are registered, and the silver table by its name."""
    database = f"tidemark_{uuid.uuid4().hex}"
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "catalog"), INCREMENT)
    job = Refresh(**{**vars(job), "catalog": database})
    for batch in batches(spark, sf_dir, CUT):
        job.run(spark, batch)
    silver = catalog.read_table(spark, database, catalog.SILVER)
    return silver.withColumns(ntz("hour_start", "hour_end"))


@register
def silver_versions(spark, sf_dir):
    """What readers see who began before a merge, ask for the version before it, or come after."""
    job = refresh_job(spark, sf_dir, fresh_folder(spark, "versions"), INCREMENT)
    first, second = batches(spark, sf_dir, CUT)
    job.run(spark, first)
    began_before = silver_of(spark, job)
    number = store.snapshot(spark, job.layout.silver).number
    job.run(spark, second)
    asked = store.read_silver(spark, job.layout.silver, version=number)
    seen = {
        "began before": began_before,
        "asked": asked.withColumns(ntz("hour_start", "hour_end")),
        "after": silver_of(spark, job),
    }
    parts = [rows.withColumn("reader", F.lit(reader)) for reader, rows in seen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- validation ------------------------------------------------------------------------------

#: Columns that somebody takes out of stored files.
LACKING = {"Bronze": "humidity", "Silver": "max_temperature"}
SCHEMA_CHECKS = (ex.COLUMN_COUNT, ex.ORDERED_COLUMNS, ex.EXISTS, ex.OF_TYPE)


def without_column(spark: SparkSession, folders: list[str], column: str) -> None:
    """Stored files rewritten without one of their columns."""
    for folder in folders:
        draft = f"{folder}.rewritten"
        spark.read.parquet(folder).drop(column).write.parquet(draft)
        delete_path(spark, folder)
        move_path(spark, draft, folder)


class Losing(Refresh):
    """A job whose newest slice loses a column before anything is checked."""

    def finish(self, spark, slice_name, *args):
        folders = store.slice_folders(spark, self.layout, slice_name)
        without_column(spark, folders, LACKING["Bronze"])
        return super().finish(spark, slice_name, *args)


@register
def suite_stored_files(spark, sf_dir):
    """Checks of the schema by the job, over stored files of which some lack a column."""
    table = refresh_job(spark, sf_dir, fresh_folder(spark, "lacking"), TABLE)
    first, second = batches(spark, sf_dir, CUT)
    stored = table.run(spark, first)
    one_slice = store.slice_folders(spark, table.layout, stored.slice_name)
    without_column(spark, one_slice[:1], LACKING["Bronze"])
    silver = table.layout.silver
    without_column(spark, store.snapshot(spark, silver).folders(silver)[:1], LACKING["Silver"])
    whole = table.run(spark, second)
    newest = refresh_job(spark, sf_dir, fresh_folder(spark, "losing"), INCREMENT)
    part = Losing(**vars(newest)).run(spark, second)
    rows = [
        (scope, report.layer, row["seq"], row["expectation_type"], row["column"], row["success"])
        for scope, summary in ((TABLE, whole), (INCREMENT, part))
        for report in (summary.bronze_report, summary.silver_report)
        for row in report.rows
        if row["expectation_type"] in SCHEMA_CHECKS or row["column"] in LACKING.values()
    ]
    schema = "scope string, layer string, seq int, expectation_type string, column string, success boolean"
    return small_frame(spark, rows, schemas.flat(schema))


KEYS = [["city", "timestamp"], ["humidity", "city"]]


@register
def unique_cumulative(spark, sf_dir):
    """Repeated keys of the bronze table after three runs, of which each reads its own slice and
    an index of keys; both kinds of key are repeated across slices and dates."""
    suite = Suite(name="keys")
    for key in KEYS:
        suite = suite.expect_compound_columns_to_be_unique(key)
    job = Refresh(
        Layout(fresh_folder(spark, "keys")), countries(spark, sf_dir), bronze_suite=suite,
        scope=CUMULATIVE, exact_digits=2, as_of=AS_OF,
    )
    report = [job.run(spark, b) for b in batches(spark, sf_dir, EARLY, CUT)][-1].bronze_report
    rows = small_frame(spark, report.rows, reports.RESULTS)
    counts = ["seq", "success", "element_count", "missing_count", "unexpected_count"]
    return rows.select(*counts).join(listed(spark, report.partial_lists), "seq", "left")


# --- averages and logs --------------------------------------------------------------------------


@register
def hourly_reproducible(spark, sf_dir):
    """Averages of doubles from integer sums of their parts, over rows dealt out anew."""
    rows = events(spark, sf_dir).repartition(7)
    return reproducible_hours(rows, "event_type", "ts", MEANS, MAXIMA, round_to=2)


@register
def silver_reproducible(spark, sf_dir):
    """The silver columns from payloads with such averages."""
    silver = reproducible_hours(bronze(spark, sf_dir).repartition(5))
    return silver.withColumns(ntz("hour_start", "hour_end"))


@register
def runlog_files(spark, sf_dir):
    """The last errors over all daily files of a log, by file and line."""
    folder = fresh_folder(spark, "log")
    lines = log_lines(spark, sf_dir).join(
        run_events(spark, sf_dir).select("seq", "log_date", "log_time"), "seq"
    )
    ordered = lines.repartition("log_date").sortWithinPartitions("log_date", "log_time", "seq")
    ordered.select("value", "log_date").write.partitionBy("log_date").text(folder)
    log = runlog.read_text_log(spark, folder)
    day = F.regexp_extract("file", r"log_date=(\d{4}-\d{2}-\d{2})", 1)
    last = runlog.tail_lines(log, 500, "ERROR")
    return last.select(day.alias("day"), F.col("seq").alias("line"), "level", "message")
