"""Suites of expectations, evaluated together.

A suite reads its table once, however many checks it holds. Every row becomes a bit
mask, one bit per row-level test, and one entry per compound key; rows of equal masks
and of equal keys are counted, and all verdicts follow from those counts. Checks of the
schema need no job. The results are a DataFrame with one row per expectation.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark import schemas
from tidemark.functions.scalars import named
from tidemark.operators import expectations as ex
from tidemark.operators.expectations import Expectation, ExpectationError
from tidemark.shared import small_frame
from tidemark.version import __version__

# The reference value: how many unexpected values a result lists.
PARTIAL_LIST_SIZE = 20
MASK_BITS = 62

RESULTS = schemas.flat(
    "seq int, expectation_type string, column string, kwargs string, success boolean, "
    "observed_value string, element_count bigint, missing_count bigint, "
    "missing_percent double, unexpected_count bigint, unexpected_percent double, "
    "unexpected_percent_total double, unexpected_percent_nonmissing double, "
    "raised_exception boolean, exception_message string"
)
RESULT_COLUMNS = RESULTS.names


@dataclass(frozen=True)
class Suite:
    """An immutable, ordered list of expectations.

    The ``expect_*`` methods return a longer suite, so calls can be chained.
    """

    expectations: tuple[Expectation, ...] = ()
    name: str = "default"

    def plus(self, expectation_type: str, **kwargs) -> Suite:
        return Suite((*self.expectations, Expectation(expectation_type, kwargs)), self.name)

    def expect_table_row_count_to_be_between(self, min_value=None, max_value=None) -> Suite:
        return self.plus(ex.ROW_COUNT, min_value=min_value, max_value=max_value)

    def expect_table_column_count_to_equal(self, value: int) -> Suite:
        return self.plus(ex.COLUMN_COUNT, value=value)

    def expect_table_columns_to_match_ordered_list(self, column_list: Sequence[str]) -> Suite:
        return self.plus(ex.ORDERED_COLUMNS, column_list=list(column_list))

    def expect_column_values_to_be_in_set(self, column: str, value_set: Iterable) -> Suite:
        return self.plus(ex.IN_SET, column=column, value_set=list(value_set))

    def expect_column_values_to_not_be_null(self, column: str) -> Suite:
        return self.plus(ex.NOT_NULL, column=column)

    def expect_column_to_exist(self, column: str) -> Suite:
        return self.plus(ex.EXISTS, column=column)

    def expect_column_values_to_be_between(
        self, column: str, min_value=None, max_value=None
    ) -> Suite:
        return self.plus(ex.BETWEEN, column=column, min_value=min_value, max_value=max_value)

    def expect_column_values_to_match_regex(self, column: str, regex: str) -> Suite:
        return self.plus(ex.REGEX, column=column, regex=regex)

    def expect_column_values_to_be_of_type(self, column: str, type_: str) -> Suite:
        return self.plus(ex.OF_TYPE, column=column, type_=type_)

    def expect_column_values_to_match_strftime_format(
        self, column: str, strftime_format: str
    ) -> Suite:
        return self.plus(ex.STRFTIME, column=column, strftime_format=strftime_format)

    def expect_compound_columns_to_be_unique(self, column_list: Sequence[str]) -> Suite:
        return self.plus(ex.COMPOUND_UNIQUE, column_list=list(column_list))

    def ordered(self) -> list[Expectation]:
        """Table-level first, then by column in the order columns were first named."""
        first_seen: dict[str | None, int] = {None: -1}
        for position, expectation in enumerate(self.expectations):
            first_seen.setdefault(expectation.column, position)
        return sorted(self.expectations, key=lambda e: first_seen[e.column])

    def is_additive(self) -> bool:
        """Whether counts over any disjoint parts of a table add up to its own counts."""
        return all(e.expectation_type != ex.COMPOUND_UNIQUE for e in self.expectations)

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One result row per expectation, lazily, numbered by ``seq``."""
        return _evaluate(df, list(enumerate(self.ordered())))

    def evaluate_by(self, df: DataFrame, group: str) -> DataFrame:
        """The same for each value of ``group``, a column that the checks do not see."""
        return _evaluate(df, list(enumerate(self.ordered())), group)


def build_suite(
    name: str = "default",
    row_count: Mapping | None = None,
    column_count: int | None = None,
    ordered_columns: Sequence[str] | None = None,
    in_set: Mapping[str, Sequence] | None = None,
    not_null: Sequence[str] = (),
    exist: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    ranges: Mapping[str, Mapping] | None = None,
    regexes: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    formats: Mapping[str, str] | None = None,
) -> Suite:
    """Expand lists and dictionaries of checks into a suite."""
    suite = Suite(name=name)
    if row_count is not None:
        suite = suite.expect_table_row_count_to_be_between(**row_count)
    if column_count is not None:
        suite = suite.expect_table_column_count_to_equal(column_count)
    if ordered_columns is not None:
        suite = suite.expect_table_columns_to_match_ordered_list(ordered_columns)
    for column, value_set in (in_set or {}).items():
        suite = suite.expect_column_values_to_be_in_set(column, value_set)
    for column in not_null:
        suite = suite.expect_column_values_to_not_be_null(column)
    for column in exist:
        suite = suite.expect_column_to_exist(column)
    for column_list in unique:
        suite = suite.expect_compound_columns_to_be_unique(column_list)
    for column, bounds in (ranges or {}).items():
        suite = suite.expect_column_values_to_be_between(column, **bounds)
    for column, regex in (regexes or {}).items():
        suite = suite.expect_column_values_to_match_regex(column, regex)
    for column, type_ in (types or {}).items():
        suite = suite.expect_column_values_to_be_of_type(column, type_)
    for column, strftime_format in (formats or {}).items():
        suite = suite.expect_column_values_to_match_strftime_format(column, strftime_format)
    return suite


ROWS = "rows"
ABOUT = (
    "array<struct<seq: int, expectation_type: string, column: string, kwargs: string, "
    "success: boolean, observed_value: string, bounded: boolean, low: double, high: double, "
    "raised_exception: boolean, exception_message: string>>"
)


@dataclass
class _Check:
    """How one expectation reads its verdict from the row of aggregates.

    ``tests`` are the predicates it counts, ``key`` the columns that must be unique.
    ``element``, ``missing`` and ``unexpected`` name counts. ``success`` and
    ``observed`` are known without a job; ``bounds`` applies to the row count.
    """

    seq: int
    expectation: Expectation
    tests: dict[str, Column] = field(default_factory=dict)
    key: list[str] | None = None
    element: str | None = None
    missing: str | None = None
    unexpected: str | None = None
    bounds: tuple | None = None
    success: bool | None = None
    observed: str | None = None
    problem: str | None = None

    def about(self) -> dict:
        low, high = self.bounds or (None, None)
        return {
            "seq": self.seq,
            "expectation_type": self.expectation.expectation_type,
            "column": self.expectation.column,
            "kwargs": self.expectation.kwargs_json,
            "success": False if self.problem is not None else self.success,
            "observed_value": self.observed,
            "bounded": self.bounds is not None,
            "low": low,
            "high": high,
            "raised_exception": self.problem is not None,
            "exception_message": self.problem,
        }

    @property
    def known(self) -> bool:
        return self.success is not None or self.problem is not None

    def counts(self) -> str:
        element, missing, unexpected = (
            name or "bigint(NULL)" for name in (self.element, self.missing, self.unexpected)
        )
        return f"named_struct('element', {element}, 'missing', {missing}, 'wrong', {unexpected})"


def _verdicts(counted: DataFrame, checks: list[_Check], groups: list[str]) -> DataFrame:
    """One row of aggregates to one row per check.

    What is known beforehand travels as one literal; the aggregates are paired
    with it by position.
    """
    about = F.from_json(F.lit(json.dumps([check.about() for check in checks])), ABOUT)
    counts = F.expr(f"array({', '.join(check.counts() for check in checks)})")
    entries = F.arrays_zip(about.alias("about"), counts.alias("counts"))
    rows, unexpected = F.col(ROWS), F.col("counts.wrong")
    inside = F.coalesce(rows >= F.col("about.low"), F.lit(True)) & F.coalesce(
        rows <= F.col("about.high"), F.lit(True)
    )
    bounded = F.col("about.bounded")
    return counted.select(*groups, ROWS, F.inline(entries)).select(
        *groups,
        "about.seq",
        "about.expectation_type",
        "about.column",
        "about.kwargs",
        F.when(bounded, inside)
        .otherwise(F.coalesce(F.col("about.success"), unexpected == 0))
        .alias("success"),
        F.when(bounded, rows.cast("string"))
        .otherwise(F.col("about.observed_value"))
        .alias("observed_value"),
        F.col("counts.element").alias("element_count"),
        F.col("counts.missing").alias("missing_count"),
        unexpected.alias("unexpected_count"),
        "about.raised_exception",
        "about.exception_message",
    )


def _as_text(observed) -> str | None:
    if observed is None or isinstance(observed, str):
        return observed
    return json.dumps(observed)


def _compile(df: DataFrame, seq: int, expectation: Expectation) -> _Check:
    check = _Check(seq, expectation)
    verdict = ex.schema_verdict(df, expectation)
    if verdict is not None:
        check.success, observed = verdict
        check.observed = _as_text(observed)
        return check
    kwargs = expectation.kwargs
    if expectation.expectation_type == ex.ROW_COUNT:
        check.bounds = (kwargs.get("min_value"), kwargs.get("max_value"))
        return check

    check.element = ROWS
    if expectation.expectation_type == ex.COMPOUND_UNIQUE:
        check.key = ex.key_columns(df, expectation)
        check.missing, check.unexpected = f"missing_key_{seq}", f"repeated_key_{seq}"
        return check
    predicate = ex.unexpected(df, expectation)
    position = [name.lower() for name in df.columns].index(expectation.column.lower())
    missing = f"missing_{position}"
    check.tests[missing] = named(expectation.column).isNull()
    if expectation.expectation_type == ex.NOT_NULL:
        check.unexpected = missing
    else:
        check.missing, check.unexpected = missing, f"unexpected_{seq}"
        check.tests[check.unexpected] = predicate
    return check


def _message(problem: Exception) -> str:
    return str(problem).split("\n", 1)[0]


def _checked(df: DataFrame, seq: int, expectation: Expectation) -> _Check:
    """Compile one expectation; what cannot be compiled becomes its result."""
    try:
        check = _compile(df, seq, expectation)
        df.select(*check.tests.values())  # analysed, not run
        return check
    except (ExpectationError, AnalysisException) as problem:
        return _Check(seq, expectation, problem=_message(problem))


def _counted(df: DataFrame, checks: list[_Check], groups: list[str]) -> DataFrame:
    """One row of counts (one per group), from one pass over ``df``.

    Rows of equal masks of tests are counted before and after a shuffle; such counts are
    few. With compound keys, a row gives one entry with its mask and one with each key, and
    equal keys are counted first, so that a hot key costs a row per task.
    """
    tests = list({name: test for check in checks for name, test in check.tests.items()}.items())
    n_masks = -(-len(tests) // MASK_BITS)
    masks = [f"__mask_{m}" for m in range(n_masks)]
    keyed = [check for check in checks if check.key is not None]
    columns = list(dict.fromkeys(name for check in keyed for name in check.key))
    places = {name: f"__key_{n}" for n, name in enumerate(columns)}

    def bits(mask: int) -> Column:
        own = tests[mask * MASK_BITS : (mask + 1) * MASK_BITS]
        parts = [
            F.when(test, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
            for bit, (_, test) in enumerate(own)
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("__n"))), F.lit(0))

    def counts_of(row: Column) -> list[Column]:
        """The number of rows and of those that each test hits."""
        counts = [total(row).alias(ROWS)]
        for number, (name, _) in enumerate(tests):
            mask, bit = masks[number // MASK_BITS], 1 << number % MASK_BITS
            hit = F.col(mask).bitwiseAND(F.lit(bit).cast("long")) != 0
            counts.append(total(row & hit).alias(name))
        return counts

    if not keyed:
        masked = df.select(*groups, *[bits(m).alias(name) for m, name in enumerate(masks)])
        few = masked.groupBy(*groups, *masks).agg(F.count(F.lit(1)).alias("__n"))
        return few.groupBy(*groups).agg(*counts_of(F.lit(True)))

    def entry(number: int, key: list[str]) -> Column:
        zero = F.lit(0).cast("long")
        values = [bits(m) if number == 0 else zero for m in range(n_masks)]
        parts = [
            (named(name) if name in key else F.lit(None).cast(df.schema[_field(df, name)].dataType))
            for name in columns
        ]
        return F.struct(
            F.lit(number).alias("__set"),
            *[value.alias(name) for value, name in zip(values, masks, strict=True)],
            *[part.alias(places[name]) for part, name in zip(parts, columns, strict=True)],
        )

    entries = [entry(0, []), *[entry(n, check.key) for n, check in enumerate(keyed, 1)]]
    spread = df.select(*groups, F.inline(F.array(*entries)))
    kept = [*groups, "__set", *masks]
    each = spread.groupBy(*kept, *places.values()).agg(F.count(F.lit(1)).alias("__n"))
    filled = reduce(lambda a, b: a | b, [F.col(p).isNotNull() for p in places.values()], F.lit(False))
    few = each.groupBy(*kept, filled.alias("__filled"), (F.col("__n") > 1).alias("__repeated"))
    few = few.agg(F.sum("__n").alias("__n"))

    counts = counts_of(F.col("__set") == 0)
    for number, check in enumerate(keyed, 1):
        own = F.col("__set") == number
        counts.append(total(own & ~F.col("__filled")).alias(check.missing))
        repeated = own & F.col("__filled") & F.col("__repeated")
        counts.append(total(repeated).alias(check.unexpected))
    return few.groupBy(*groups).agg(*counts)


def _field(df: DataFrame, column: str) -> str:
    """A column's own spelling of its name."""
    return next(name for name in df.columns if name.lower() == column.lower())


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") * 100 / whole)


def _with_percentages(results: DataFrame) -> DataFrame:
    element, missing = F.col("element_count"), F.col("missing_count")
    wrong = F.col("unexpected_count")
    nonmissing = _percent(wrong, element - missing)
    total = _percent(wrong, element)
    return results.withColumns(
        {
            "missing_percent": _percent(missing, element),
            "unexpected_percent": F.when(missing.isNull(), total).otherwise(nonmissing),
            "unexpected_percent_total": total,
            "unexpected_percent_nonmissing": nonmissing,
        }
    )


def _known_rows(spark, checks: list[_Check]) -> DataFrame:
    """Verdicts that need no job, as a local relation."""
    rows = []
    for check in checks:
        values = dict.fromkeys(RESULT_COLUMNS)
        about = check.about()
        values.update({name: about[name] for name in values if name in about})
        rows.append(tuple(values[name] for name in RESULT_COLUMNS))
    return small_frame(spark, rows, RESULTS)


def _evaluate(
    df: DataFrame, numbered: list[tuple[int, Expectation]], group: str | None = None
) -> DataFrame:
    spark, groups = df.sparkSession, [] if group is None else [group]
    seen = df.drop(*groups)
    checks = [_checked(seen, seq, expectation) for seq, expectation in numbered]
    known = [check for check in checks if check.known]
    counting = [check for check in checks if not check.known]
    if groups:
        counted = _counted(df, counting, groups)
        results = _with_percentages(_verdicts(counted, checks, groups))
        return results.select(*groups, *RESULT_COLUMNS)
    parts = [_known_rows(spark, known)] if known or not checks else []
    if counting:
        results = _with_percentages(_verdicts(_counted(df, counting, []), counting, []))
        parts.append(results.select(*RESULT_COLUMNS))
    return reduce(DataFrame.unionAll, parts)


def combine(parts: DataFrame) -> DataFrame:
    """Results over disjoint parts of a table as results over the whole table.

    Rows of one expectation, one per part, become one row. Only suites whose
    counts add up can be combined; see ``Suite.is_additive``.
    """
    keys = ["seq", "expectation_type", "column", "kwargs"]
    is_row_count = F.col("expectation_type") == ex.ROW_COUNT
    observed = F.col("observed_value")
    telling = F.struct((~F.col("success")).alias("failed"), observed.alias("value"))
    grouped = parts.groupBy(*keys).agg(
        F.sum("element_count").alias("element_count"),
        F.sum("missing_count").alias("missing_count"),
        F.sum("unexpected_count").alias("unexpected_count"),
        F.bool_and("success").alias("all_succeeded"),
        F.sum(F.when(is_row_count, observed.try_cast("bigint"))).alias("rows"),
        F.max(telling)["value"].alias("observed"),
        F.bool_or("raised_exception").alias("raised_exception"),
        F.max("exception_message").alias("exception_message"),
    )
    bounds = F.from_json("kwargs", "min_value double, max_value double")
    rows = F.col("rows")
    inside = F.coalesce(rows >= bounds["min_value"], F.lit(True)) & F.coalesce(
        rows <= bounds["max_value"], F.lit(True)
    )
    success = F.when(is_row_count & ~F.col("raised_exception"), inside).otherwise(
        F.col("all_succeeded")
    )
    return _with_percentages(
        grouped.withColumns(
            {
                "success": success,
                "observed_value": F.when(is_row_count, rows.cast("string")).otherwise(
                    F.col("observed")
                ),
            }
        )
    ).select(*RESULT_COLUMNS)


def statistics_columns() -> list[Column]:
    evaluated = F.count(F.lit(1))
    successful = F.count_if(F.col("success"))
    percent = F.when(evaluated > 0, successful.cast("double") * 100 / evaluated)
    return [
        evaluated.alias("evaluated_expectations"),
        successful.alias("successful_expectations"),
        (evaluated - successful).alias("unsuccessful_expectations"),
        percent.alias("success_percent"),
    ]


def statistics(results: DataFrame) -> DataFrame:
    """Counts and success percentage; the percentage of no expectations is NULL."""
    return results.agg(*statistics_columns())


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success"))


def offenders(df: DataFrame, expectation: Expectation) -> DataFrame:
    """All rows that violate a row-level expectation."""
    return df.filter(ex.unexpected(df, expectation))


def list_order(value) -> tuple:
    """Unexpected values are listed in ascending order, numbers before other texts."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return 0, float(value), ""
    text = value if isinstance(value, str) else json.dumps(value)
    return 1, 0.0, text


def merge_lists(lists: Iterable[list], size: int = PARTIAL_LIST_SIZE) -> list:
    """The list over disjoint parts of a table from those of the parts."""
    return sorted((value for own in lists for value in own), key=list_order)[:size]


def partial_lists(
    df: DataFrame,
    failed: list[tuple[int, Expectation]],
    size: int = PARTIAL_LIST_SIZE,
    group: str | None = None,
) -> dict[tuple[str | None, int], list]:
    """The ``size`` smallest unexpected values of each failed check, by (group, seq).

    One pass serves all row-level checks: each task keeps the first values of each check
    before anything is shuffled. A compound key is grouped once more. Checks that count
    nulls have nothing to list.
    """
    part = F.lit(None).cast("string") if group is None else F.col(group).cast("string")
    entries, found = [], []
    empty = {"ignoreNullFields": "false"}
    for seq, expectation in failed:
        if expectation.expectation_type == ex.COMPOUND_UNIQUE:
            keys = expectation.kwargs["column_list"]
            repeated = ex.repeated_keys(df, list(dict.fromkeys([*keys, *[group] * bool(group)])))
            text = F.to_json(F.struct(*map(named, keys)), empty)
            found.append(
                repeated.select(
                    part.alias("part"),
                    F.lit(seq).alias("seq"),
                    F.lit(None).cast("double").alias("number"),
                    text.alias("text"),
                    text.alias("value"),
                )
            )
        elif expectation.expectation_type != ex.NOT_NULL:
            value = named(expectation.column)
            numeric = isinstance(df.schema[_field(df, expectation.column)].dataType, T.NumericType)
            entry = F.struct(
                part.alias("part"),
                F.lit(seq).alias("seq"),
                (value.cast("double") if numeric else F.lit(None).cast("double")).alias("number"),
                value.cast("string").alias("text"),
                F.to_json(F.struct(value.alias("v"))).alias("value"),
            )
            entries.append(F.when(ex.unexpected(df, expectation), entry))
    if entries:
        found.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    if not found:
        return {}
    order = Window.partitionBy("part", "seq").orderBy(F.col("number").asc_nulls_last(), "text")
    ranked = reduce(DataFrame.unionAll, found).withColumn("place", F.row_number().over(order))
    keyed = {seq for seq, e in failed if e.expectation_type == ex.COMPOUND_UNIQUE}
    lists: dict[tuple[str | None, int], list] = {}
    for row in ranked.filter(F.col("place") <= size).collect():
        value = json.loads(row["value"])
        own = lists.setdefault((row["part"], row["seq"]), [])
        own.append(value if row["seq"] in keyed else value["v"])
    return {key: sorted(values, key=list_order) for key, values in lists.items()}


def list_of(row: Row, lists: Mapping, part: str | None = None) -> list:
    """The list of a failed result; missing values are listed as such."""
    if row["expectation_type"] == ex.NOT_NULL:
        return [None] * min(row["unexpected_count"], PARTIAL_LIST_SIZE)
    return lists.get((part, row["seq"]), [])


@dataclass
class ValidationReport:
    """The outcome of one validation run; as small as the suite itself."""

    rows: list[Row]
    partial_lists: dict[int, list]
    suite_name: str
    layer: str
    run_id: str
    run_time: datetime
    #: When the checks had been evaluated; the run began before that.
    validation_time: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def success(self) -> bool:
        return all(row["success"] for row in self.rows)

    @property
    def statistics(self) -> dict:
        evaluated = len(self.rows)
        successful = sum(row["success"] for row in self.rows)
        return {
            "evaluated_expectations": evaluated,
            "successful_expectations": successful,
            "unsuccessful_expectations": evaluated - successful,
            "success_percent": successful * 100 / evaluated if evaluated else None,
        }

    @property
    def failed_types(self) -> list[str]:
        return [row["expectation_type"] for row in self.rows if not row["success"]]

    def to_json_dict(self) -> dict:
        """The run as one nested document."""
        return {
            "success": self.success,
            "results": [self._result(row) for row in self.rows],
            "evaluation_parameters": {},
            "statistics": self.statistics,
            "meta": {
                "expectation_suite_name": self.suite_name,
                "run_id": {"run_name": self.run_id, "run_time": self.run_time.isoformat()},
                "validation_time": self.validation_time.strftime("%Y%m%dT%H%M%S.%fZ"),
                "tidemark_version": __version__,
                "layer": self.layer,
            },
        }

    def _result(self, row: Row) -> dict:
        return {
            "success": row["success"],
            "expectation_config": {
                "expectation_type": row["expectation_type"],
                "kwargs": {**json.loads(row["kwargs"]), "result_format": "BASIC"},
                "meta": {},
            },
            "result": self._fields(row),
            "meta": {},
            "exception_info": {
                "raised_exception": row["raised_exception"],
                "exception_message": row["exception_message"],
                "exception_traceback": None,
            },
        }

    def _fields(self, row: Row) -> dict:
        if row["raised_exception"]:
            return {}
        if row["unexpected_count"] is not None:
            names = ["element_count"]
            if row["missing_count"] is not None:
                names += ["missing_count", "missing_percent"]
            names += ["unexpected_count", "unexpected_percent", "unexpected_percent_total"]
            if row["missing_count"] is not None:
                names.append("unexpected_percent_nonmissing")
            counted = {name: row[name] for name in names}
            return {**counted, "partial_unexpected_list": self.partial_lists.get(row["seq"], [])}
        if row["observed_value"] is None:
            return {}
        observed = row["observed_value"]
        if row["expectation_type"] != ex.OF_TYPE:
            observed = json.loads(observed)
        return {"observed_value": observed}


class ValidationFailed(Exception):
    def __init__(self, report: ValidationReport):
        self.report = report
        super().__init__(f"{report.layer}: failed {', '.join(report.failed_types)}")


def validate(
    df: DataFrame,
    suite: Suite,
    layer: str = "",
    run_id: str | None = None,
    run_time: datetime | None = None,
    partial_list_size: int = PARTIAL_LIST_SIZE,
    on_failure: str = "report",
) -> ValidationReport:
    """Evaluate a suite now. Only counts and a bounded list of values are collected.

    A check that fails, or that cannot be evaluated on this table, never stops the others,
    and by default nothing is gated on the outcome; ``on_failure="raise"`` turns a failed
    suite into an error. An error of the engine, such as a damaged file, is no verdict: it
    is raised.
    """
    run_time = run_time or datetime.now(timezone.utc)
    numbered = list(enumerate(suite.ordered()))
    rows = sorted(_evaluate(df, numbered).collect(), key=lambda row: row["seq"])
    wrong = [row for row in rows if row["unexpected_count"]]
    lists = partial_lists(df, [numbered[row["seq"]] for row in wrong], partial_list_size)
    report = ValidationReport(
        rows,
        {row["seq"]: list_of(row, lists) for row in wrong},
        suite.name,
        layer,
        run_id or run_time.isoformat(),
        run_time,
    )
    if on_failure == "raise" and not report.success:
        raise ValidationFailed(report)
    return report
