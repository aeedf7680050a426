"""Expectations: what each one counts, as column expressions.

An expectation is data. Row-level ones become an ``unexpected`` predicate over
non-null values; schema-level ones are decided from the declared schema without
a job; compound uniqueness needs a grouping of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import matches_strftime, named

# Expectation names.
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_COUNT = "expect_table_column_count_to_equal"
ORDERED_COLUMNS = "expect_table_columns_to_match_ordered_list"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
EXISTS = "expect_column_to_exist"
BETWEEN = "expect_column_values_to_be_between"
REGEX = "expect_column_values_to_match_regex"
OF_TYPE = "expect_column_values_to_be_of_type"
STRFTIME = "expect_column_values_to_match_strftime_format"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"


@dataclass(frozen=True)
class Expectation:
    expectation_type: str
    kwargs: Mapping[str, Any] = field(default_factory=dict, hash=False)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")

    @property
    def kwargs_json(self) -> str:
        return json.dumps(dict(self.kwargs), default=str)


class ExpectationError(Exception):
    """An expectation that cannot be evaluated on this table."""


def _type_of(df: DataFrame, column: str) -> T.DataType:
    for entry in df.schema.fields:
        if entry.name == column:
            return entry.dataType
    for entry in df.schema.fields:
        if entry.name.lower() == column.lower():
            return entry.dataType
    raise ExpectationError(f"column {column!r} does not exist")


def type_name(data_type: T.DataType) -> str:
    return type(data_type).__name__


def _beside(df: DataFrame, column: str, value: Any) -> tuple[Column, Column]:
    """A column and a literal as two columns that can be compared for every row.

    Text is read as a number beside a number, and a literal takes the type of any other
    column; what cannot be read becomes NULL instead of an error.
    """
    kind = _type_of(df, column)
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(kind, T.StringType):
        return (named(column).try_cast("double") if number else named(column)), F.lit(value)
    if isinstance(kind, T.NumericType) and number:
        return named(column), F.lit(value)
    return named(column), F.lit(value).try_cast(kind)


def within(df: DataFrame, column: str, low, high) -> Column:
    """Inclusive bounds; None leaves a side open. A value that cannot be compared is outside."""
    inside = F.lit(True)
    if low is not None:
        value, bound = _beside(df, column, low)
        inside = inside & (value >= bound)
    if high is not None:
        value, bound = _beside(df, column, high)
        inside = inside & (value <= bound)
    return F.coalesce(inside, F.lit(False))


def _in_set(df: DataFrame, kwargs) -> Column:
    listed = F.lit(False)
    texts = isinstance(_type_of(df, kwargs["column"]), T.StringType)
    values = [value for value in kwargs["value_set"] if value is not None]
    if texts and all(isinstance(value, str) for value in values):
        return ~named(kwargs["column"]).isin(values)
    for entry in values:
        value, other = _beside(df, kwargs["column"], entry)
        listed = listed | F.coalesce(value == other, F.lit(False))
    return ~listed


def _between(df: DataFrame, kwargs) -> Column:
    return ~within(df, kwargs["column"], kwargs.get("min_value"), kwargs.get("max_value"))


def _regex(df: DataFrame, kwargs) -> Column:
    pattern = df.sparkSession.sparkContext._jvm.java.util.regex.Pattern
    try:
        pattern.compile(kwargs["regex"])
    except IllegalArgumentException as problem:
        raise ExpectationError(str(problem)) from problem
    return ~named(kwargs["column"]).cast("string").rlike(kwargs["regex"])


def _strftime(df: DataFrame, kwargs) -> Column:
    if not isinstance(_type_of(df, kwargs["column"]), T.StringType):
        raise ExpectationError(f"{STRFTIME} needs a string column")
    try:
        return ~matches_strftime(named(kwargs["column"]), kwargs["strftime_format"])
    except ValueError as problem:
        raise ExpectationError(str(problem)) from problem


VALUE_RULES: dict[str, Callable[[DataFrame, Mapping], Column]] = {
    IN_SET: _in_set,
    BETWEEN: _between,
    REGEX: _regex,
    STRFTIME: _strftime,
}


def unexpected(df: DataFrame, expectation: Expectation) -> Column:
    """The predicate that marks a row as unexpected; never NULL."""
    kind, kwargs = expectation.expectation_type, expectation.kwargs
    rule = VALUE_RULES.get(kind)
    if rule is None and kind != NOT_NULL:
        raise ExpectationError(f"{kind} has no row predicate")
    _type_of(df, kwargs["column"])
    is_missing = named(kwargs["column"]).isNull()
    if rule is None:
        return is_missing
    return ~is_missing & rule(df, kwargs)


def schema_verdict(df: DataFrame, expectation: Expectation) -> tuple[bool, Any] | None:
    """(success, observed value) of a schema-level expectation, else None."""
    kind, kwargs = expectation.expectation_type, expectation.kwargs
    if kind == COLUMN_COUNT:
        return len(df.columns) == kwargs["value"], len(df.columns)
    if kind == ORDERED_COLUMNS:
        return df.columns == list(kwargs["column_list"]), df.columns
    if kind == EXISTS:
        return kwargs["column"] in df.columns, None
    if kind == OF_TYPE:
        observed = type_name(_type_of(df, kwargs["column"]))
        return observed == kwargs["type_"], observed
    return None


def compound_groups(df: DataFrame, column_list: list[str]) -> DataFrame:
    """Rows per key. The keys combine before the shuffle, whatever their skew."""
    keys = [named(column) for column in column_list]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))


def any_key(column_list: list[str]) -> Column:
    """Whether a row has any part of a compound key."""
    held = F.lit(False)
    for column in column_list:
        held = held | named(column).isNotNull()
    return held


def repeated_keys(df: DataFrame, column_list: list[str]) -> DataFrame:
    """The keys that more than one row has; the key of NULLs alone does not count."""
    groups = compound_groups(df, column_list).filter(F.col("__rows") > 1)
    return groups.filter(any_key(column_list)).drop("__rows")


def key_columns(df: DataFrame, expectation: Expectation) -> list[str]:
    """The columns of a compound key, under the names that the table has for them."""
    columns = expectation.kwargs["column_list"]
    for column in columns:
        _type_of(df, column)
    return list(columns)
