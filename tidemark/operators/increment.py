"""High-water marks: which rows of a batch are new, and where the mark goes next.

A mark is one value per tracked table, kept as a row of the control table. It
is not an event-time watermark: a row at or before the mark is dropped, also
when it is another entity that raised the mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import named


def mark_row(control: DataFrame, table_name: str) -> DataFrame:
    """Point lookup in the control table, as a DataFrame of at most one row."""
    return control.filter(F.col("TableName") == table_name).select("WatermarkValue")


def lookup_mark(control: DataFrame, table_name: str):
    """The stored mark as a value; None when the table is not tracked yet."""
    row = mark_row(control, table_name).first()
    return None if row is None else row[0]


def _literal(batch: DataFrame, column: str, mark) -> Column:
    return F.lit(mark).cast(batch.select(named(column)).schema[0].dataType)


def above_mark(batch: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly above the mark; the whole batch when there is no mark.

    The mark is passed as a literal of the column's own type, so the comparison
    reaches the scan instead of casting the column.
    """
    return batch if mark is None else batch.filter(named(column) > _literal(batch, column, mark))


def late_rows(batch: DataFrame, column: str, mark) -> DataFrame:
    """The rows ``above_mark`` leaves out although they have a time."""
    if mark is None:
        return batch.filter(F.lit(False))
    return batch.filter(named(column) <= _literal(batch, column, mark))


ENTITY_MARK = "__mark"


def entity_marks(rows: DataFrame, entities: list[str], column: str) -> DataFrame:
    """One mark per entity."""
    return rows.groupBy(*entities).agg(F.max(named(column)).alias(ENTITY_MARK))


def raise_entity_marks(marks: DataFrame, increment: DataFrame, entities: list[str]) -> DataFrame:
    """The marks after an increment, from both: an entity keeps the higher one, a new one enters."""
    return marks.unionByName(increment).groupBy(*entities).agg(F.max(ENTITY_MARK).alias(ENTITY_MARK))


def beside_entity_marks(batch: DataFrame, marks: DataFrame, entities: list[str]) -> DataFrame:
    """``batch`` with each entity's mark. The marks grow with the number of entities, so Spark
    chooses the join by their size."""
    return batch.join(marks, entities, "left")


def above_entity_marks(
    batch: DataFrame,
    marks: DataFrame,
    entities: list[str],
    column: str,
    least=None,
) -> DataFrame:
    """Opt-in variant: each entity is compared with its own mark.

    An entity without a mark is new and passes whole, or, given the ``least`` of all marks,
    from there on: no row at or before it can be new then, and the comparison with this
    literal reaches the scan, ahead of the join.
    """
    if least is not None:
        batch = above_mark(batch, column, least)
    joined = beside_entity_marks(batch, marks, entities)
    new = F.col(ENTITY_MARK).isNull() | (named(column) > F.col(ENTITY_MARK))
    return joined.filter(named(column).isNotNull() & new).select(*batch.columns)


def next_mark(increment: DataFrame, column: str, old: Column | None = None) -> DataFrame:
    """The mark after an increment; an empty increment leaves the old one."""
    new = F.max(named(column))
    return increment.agg((new if old is None else F.coalesce(new, old)).alias("WatermarkValue"))


def update_control(control: DataFrame, table_name: str, mark: Column) -> DataFrame:
    """Keyed UPDATE: other rows keep their value and no row is added."""
    value = F.when(F.col("TableName") == table_name, mark).otherwise(F.col("WatermarkValue"))
    return control.withColumn("WatermarkValue", value)


def advance_control(control: DataFrame, table_name: str, mark: str) -> DataFrame:
    """UPDATE, or INSERT when the table is tracked for the first time."""
    others = control.filter(~F.col("TableName").eqNullSafe(table_name))
    own = control.sparkSession.range(1).select(
        F.lit(table_name).alias("TableName"), F.lit(mark).alias("WatermarkValue")
    )
    return others.unionByName(own)
