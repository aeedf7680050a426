"""The composite job: one increment from payloads to a refreshed silver table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregate import hourly_aggregate, only_touched, touched_hours
from tidemark.operators.enrich import to_bronze
from tidemark.operators.expectations import COMPOUND_UNIQUE
from tidemark.operators.exactsum import hourly_reproducible
from tidemark.operators.increment import (
    ENTITY_MARK,
    beside_entity_marks,
    entity_marks,
    raise_entity_marks,
)
from tidemark.operators.suite import Suite, ValidationFailed, ValidationReport, validate
from tidemark.plans import catalog, reports, store
from tidemark.plans.keyindex import KeyIndex
from tidemark.plans.store import STARTED, WRITTEN, Layout
from tidemark.shared import small_frame
from tidemark.sources import landing
from tidemark.sources.payloads import flatten_payloads
from tidemark.sources.runlog import append_events

# What a run validates. TABLE: both tables whole, after the merge. INCREMENT: the
# new slice and the refreshed hours, before the merge. CUMULATIVE: as TABLE, but only
# what is new is read: the counts of the new slice are added to those of the previous
# run's report, and silver is counted again for the rewritten dates alone.
TABLE, INCREMENT, CUMULATIVE = "table", "increment", "cumulative"


def _digest(columns: Sequence[str]) -> str:
    return hashlib.sha256(json.dumps(list(columns)).encode()).hexdigest()[:16]


@dataclass
class RunSummary:
    slice_name: str
    old_mark: str | None
    new_mark: str | None
    accepted_rows: int
    rejected_rows: int = 0
    late_rows: int = 0
    bronze_report: ValidationReport | None = None
    silver_report: ValidationReport | None = None


@dataclass(frozen=True)
class Refresh:
    """Settings of the hourly job. Suites left at None are not evaluated.

    ``exact_digits`` makes averages independent of partitioning, for measures
    known to have at most that many decimals; ``reproducible`` does so for any measures.
    ``entity_marks`` compares rows with the mark of their own city, so that a slow city loses
    nothing to a fast one. ``catalog`` names a database in which the tables are registered.
    """

    layout: Layout
    countries: DataFrame
    table_name: str = "weather_data"
    bronze_suite: Suite | None = None
    silver_suite: Suite | None = None
    scope: str = TABLE
    on_failure: str = "report"
    exact_digits: int | None = None
    reproducible: bool = False
    entity_marks: bool = False
    catalog: str | None = None
    as_of: datetime | str | None = None
    keep_log: bool = True

    def bronze_rows(self, payloads: DataFrame) -> DataFrame:
        """Bronze rows of ``(city, payload)`` rows, each with its ``payload``."""
        inputs = flatten_payloads(payloads, self.as_of, keep_payload=True)
        return to_bronze(inputs, self.countries, keep=("payload", "faults"))

    def run(self, spark: SparkSession, payloads: DataFrame) -> RunSummary:
        """One scheduled run over a batch of ``(city, payload)`` rows.

        The mark moves last, after bronze and silver hold the increment. What a run that
        stopped earlier has written is finished first, and nothing of it is ever replaced
        by another batch.
        """
        with self.logged(spark):
            self.recover(spark)
            return self._run(spark, payloads)

    def run_landed(
        self, spark: SparkSession, path: str, most_files: int | None = 100_000
    ) -> RunSummary:
        """One scheduled run over the files below ``path``/city=<name>/ that no earlier run has
        taken, the oldest ``most_files`` of them. Which they are is noted with the slice, so a
        run that stops and is finished later takes its files along, and one that is removed
        leaves them for the next."""
        with self.logged(spark):
            self.recover(spark)
            known = store.read_landed(spark, self.layout)
            files = landing.new_files(landing.landed_files(spark, path), known, most_files)
            return self._run(spark, landing.read_files(spark, files, path), files)

    def _run(
        self, spark: SparkSession, payloads: DataFrame, files: DataFrame | None = None
    ) -> RunSummary:
        generation = store.latest_generation(spark, self.layout)
        mark = store.read_mark(spark, self.layout, self.table_name, generation)
        previous = store.read_source(spark, self.layout, self.table_name).get("slice")
        name = store.new_slice(generation)
        summary = self.apply(spark, payloads, name, mark, previous, self.table_name, files=files)
        self._end(spark, summary)
        return summary

    def recover(self, spark: SparkSession) -> None:
        """Finish the slices of runs of this job that stopped: remove what was not written
        whole, merge what was, and move the mark. Nothing is gated on it again."""
        for name, facts in store.pending_slices(spark, self.layout).items():
            if facts["source"] != self.table_name:
                continue
            if facts["state"] == STARTED:
                store.remove_slice(spark, self.layout, name)
                store.forget_landed(spark, self.layout, name)
                store.forget_pending(spark, self.layout, name)
                continue
            ungated = replace(self, on_failure="report")
            summary = ungated.finish(spark, name, facts["mark"], facts["previous"], facts)
            self._end(spark, summary)

    def _end(self, spark: SparkSession, summary: RunSummary) -> None:
        layout, source = self.layout, self.table_name
        generation = store.latest_generation(spark, layout)
        store.write_mark(spark, layout, source, summary.new_mark, generation)
        known = store.read_source(spark, layout, source)
        facts = self.after_slice(spark, known, summary.slice_name)
        store.write_source(spark, layout, source, **facts)
        store.forget_pending(spark, layout, summary.slice_name)
        self.registered(spark, summary)

    def registered(self, spark: SparkSession, summary: RunSummary) -> None:
        """Show the result of a run under the names of the catalog, if it has any."""
        if self.catalog is not None:
            catalog.register(spark, self.layout, self.catalog, summary)

    def after_slice(self, spark: SparkSession, known: dict, name: str) -> dict:
        """What is known of a source once ``name`` is its last slice."""
        kept = [*(n for n in known.get("marks", []) if n != name), name]
        store.forget_entity_marks(spark, self.layout, kept[: -store.KEPT_MARKS])
        return {"slice": name, "marks": kept[-store.KEPT_MARKS :]}

    @contextmanager
    def logged(self, spark: SparkSession) -> Iterator[None]:
        """Every failure leaves an ERROR event before it goes on."""
        try:
            yield
        except Exception as problem:
            if self.keep_log:
                line = str(problem).split("\n", 1)[0]
                event = ("ERROR", f"run stopped by {type(problem).__name__}: {line}")
                append_events(spark, self.layout.runlog, [event])
            raise

    def apply(
        self,
        spark: SparkSession,
        payloads: DataFrame,
        slice_name: str,
        mark: str | None,
        previous_slice: str | None,
        source: str,
        filtered: bool = True,
        files: DataFrame | None = None,
    ) -> RunSummary:
        """Append the rows of ``payloads`` above ``mark``, or above the mark of their city (and
        those without a time, for the quarantine), to bronze and refresh the hours they touch.

        Payloads are evaluated once, by the write, which also counts the rows that it leaves
        out; everything after reads the written slice. ``previous_slice`` names the slice of
        the run just before this one. Unless ``filtered``, no row is left out. ``files`` are
        what the payloads were read from.
        """
        layout = self.layout
        facts = {"source": source, "mark": mark, "previous": previous_slice}
        store.set_pending(spark, layout, slice_name, state=STARTED, **facts)
        if files is not None:
            store.write_landed(files, layout, slice_name)
        late, all_rows = F.lit(False), self.bronze_rows(payloads)
        if self.entity_marks:
            marks = self._marks_before(spark, slice_name, previous_slice)
            if filtered:
                all_rows = beside_entity_marks(all_rows, marks, [store.ENTITY])
                late = F.col("timestamp") <= F.col(ENTITY_MARK)
        elif filtered and mark is not None:
            late = F.col("timestamp") <= F.lit(mark)
        late = F.coalesce(late, F.lit(False))
        seen, counted = Observation(), F.count_if(late).alias("late")
        rows = all_rows.observe(seen, counted).filter(~late)
        store.write_slice(rows, layout, slice_name)
        if store.holds_rows(spark, layout, slice_name):
            facts["late"] = seen.get["late"]
        else:  # a write that turns out to be empty observes nothing
            facts["late"] = all_rows.agg(counted).first()[0]
        store.set_pending(spark, layout, slice_name, state=WRITTEN, **facts)
        return self.finish(spark, slice_name, mark, previous_slice, facts)

    def finish(
        self,
        spark: SparkSession,
        slice_name: str,
        mark: str | None,
        previous_slice: str | None,
        facts: dict,
    ) -> RunSummary:
        """Validate a written slice and merge the hours it touches; may be repeated."""
        layout = self.layout
        written = store.read_slice(spark, layout, slice_name)
        if self.entity_marks:
            marks = self._marks_before(spark, slice_name, previous_slice)
            raised = entity_marks(written, [store.ENTITY], "timestamp")
            raised = raise_entity_marks(marks, raised, [store.ENTITY])
            store.write_entity_marks(raised, layout, slice_name)
        newest, n_rows, rejected = store.slice_counts(spark, layout, slice_name)
        new_mark = newest if mark is None or (newest or "") > mark else mark
        summary = RunSummary(slice_name, mark, new_mark, n_rows, rejected, facts["late"])
        events = [
            (
                "INFO",
                f"slice {slice_name}: {n_rows} rows stored, {summary.rejected_rows} rejected, "
                f"{summary.late_rows} late",
            )
        ]
        if self.bronze_suite is not None:
            summary.bronze_report = self._validate_bronze(spark, slice_name, previous_slice)
        if n_rows:
            fresh = self._touched_aggregate(spark, written, slice_name)
            store.stage_updates(spark, layout.silver, fresh)
            if self.silver_suite is not None and self.scope == INCREMENT:
                updates = store.staged_as_stored(spark, layout.silver)
                report = validate(updates, self.silver_suite, "Silver", slice_name)
                summary.silver_report = self._report(spark, report)
            store.merge_staged(spark, layout.silver)
            events.append(("INFO", f"silver refreshed up to {summary.new_mark}"))
            if self.silver_suite is not None and self.scope != INCREMENT:
                summary.silver_report = self._validate_silver(spark, slice_name)
        else:
            events.append(("INFO", "no new rows, the mark stays"))
        if self.keep_log:
            for report in (summary.bronze_report, summary.silver_report):
                if report is not None and not report.success:
                    failed = ", ".join(report.failed_types)
                    events.append(("ERROR", f"checks of {report.layer} failed: {failed}"))
            append_events(spark, layout.runlog, events)
        return summary

    def _marks_before(
        self, spark: SparkSession, slice_name: str, previous: str | None
    ) -> DataFrame:
        """The mark of each city before a slice. A source without any slice starts without
        marks; one that has kept none so far gets them once, from the bronze table."""
        kept = store.read_entity_marks(spark, self.layout, previous)
        if kept is not None:
            return kept
        if previous is None:
            return small_frame(spark, [], store.ENTITY_MARKS)
        first = f"{slice_name}.before"
        kept = store.read_entity_marks(spark, self.layout, first)
        if kept is None:
            bronze = store.read_bronze(spark, self.layout)
            marks = entity_marks(bronze, [store.ENTITY], "timestamp")
            store.write_entity_marks(marks, self.layout, first)
            kept = store.read_entity_marks(spark, self.layout, first)
        return kept

    def _touched_aggregate(
        self, spark: SparkSession, written: DataFrame, slice_name: str
    ) -> DataFrame:
        """Aggregate of every bronze row in a touched hour.

        Only folders of touched dates are read, and rows are aggregated before they meet
        the touched hours, so what is shuffled and joined is hours.
        """
        bronze = store.read_dates_of_slice(spark, self.layout, slice_name)
        if self.reproducible:
            hours = hourly_reproducible(bronze)
        else:
            hours = hourly_aggregate(bronze, exact_digits=self.exact_digits)
        return only_touched(hours, touched_hours(written))

    def _validate_bronze(
        self, spark: SparkSession, slice_name: str, previous: str | None
    ) -> ValidationReport:
        suite = self.bronze_suite
        if self.scope == TABLE:
            return self._report(spark, self._whole_bronze(spark, slice_name))
        stored = store.as_stored(spark, self.layout, slice_name)
        own = validate(stored, suite, "Bronze_slice", slice_name)
        reports.write_report(spark, own, self.layout.reports)
        if self.scope == INCREMENT:
            return self._checked(own)
        keys = self._keys(spark, stored, slice_name, previous)
        if previous is None and store.holds_only(spark, self.layout, slice_name):
            return self._report(spark, replace(own, layer="Bronze"))
        combined = reports.combined_report(
            spark, self.layout.reports, own, previous, suite, "Bronze", keys
        )
        if combined is None:
            combined = self._whole_bronze(spark, slice_name)
        return self._report(spark, combined)

    def _keys(
        self, spark: SparkSession, stored: DataFrame, slice_name: str, previous: str | None
    ) -> dict[int, tuple[int, list]]:
        """What a slice does to each compound check of bronze: by how much the rows with
        repeated keys grow, and keys that are repeated now. Keys of earlier slices come from an
        index, which is made of the table when there is none yet."""
        grown = {}
        for seq, expectation in enumerate(self.bronze_suite.ordered()):
            columns = expectation.kwargs.get("column_list")
            known = [name.lower() for name in stored.columns]
            if expectation.expectation_type != COMPOUND_UNIQUE or not all(
                column.lower() in known for column in columns
            ):
                continue
            index = KeyIndex(f"{self.layout.state}/keys/{_digest(columns)}", columns)
            if previous is not None and not index.runs(spark):
                others = store.read_other_slices(spark, self.layout, slice_name)
                index.add(others, f"before-{slice_name}")
            count, texts = index.add(stored, slice_name)
            grown[seq] = (count, [json.loads(text) for text in texts])
        return grown

    def _whole_bronze(self, spark: SparkSession, slice_name: str) -> ValidationReport:
        parts = store.stored_parts(spark, self.layout)
        return reports.validate_parts(parts, self.bronze_suite, "Bronze", slice_name)

    def _validate_silver(self, spark: SparkSession, slice_name: str) -> ValidationReport:
        suite, path = self.silver_suite, self.layout.silver
        if self.scope == TABLE:
            parts = store.silver_parts(spark, path)
            report = reports.validate_parts(parts, suite, "Silver", slice_name, keys_apart=True)
            return self._report(spark, report)
        known = reports.known_parts(spark, self.layout.reports, suite)
        dates = store.read_changed_dates(spark, path, known)
        reports.write_parts(spark, dates, store.SILVER_PARTITION, suite, self.layout.reports)
        report = reports.report_of_parts(spark, self.layout.reports, suite, "Silver", slice_name)
        return self._report(spark, report)

    def _report(self, spark: SparkSession, report: ValidationReport) -> ValidationReport:
        reports.write_report(spark, report, self.layout.reports)
        return self._checked(report)

    def _checked(self, report: ValidationReport) -> ValidationReport:
        if self.on_failure == "raise" and not report.success:
            raise ValidationFailed(report)
        return report
