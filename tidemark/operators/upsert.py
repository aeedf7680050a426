"""Keyed upsert with MERGE semantics, as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import named

INSERT = "insert"
ABSENT = "absent"


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [named(key).isNotNull() for key in keys])


def _one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows by key with the marker ``__in_source``, which raises on a repeat.

    Repeats collapse in the partial aggregation, so a hot repeated key fails
    fast instead of filling a task. A source that is already grouped by the
    keys is not shuffled again.
    """
    others = [name for name in source.columns if name not in keys]
    message = F.lit("upsert: several source rows for one key")
    only = F.when(F.col("__rows") == 1, F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return (
        source.groupBy(*[named(key) for key in keys])
        .agg(F.count(F.lit(1)).alias("__rows"), *[F.first(named(c)).alias(c) for c in others])
        .withColumn("__in_source", only)
        .drop("__rows")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    null_keys: str = INSERT,
) -> DataFrame:
    """``target`` after merging ``source`` into it.

    Matched on plain equality of all ``keys``: only ``update_columns`` are taken
    from the source, also when they are NULL there. Not matched: the whole
    source row is inserted, by column name. Two source rows for one key raise.

    A NULL key equals nothing, so such rows stay in the target and are inserted
    from the source. They go around the join and never meet in one partition.
    ``null_keys="absent"`` states that there are none and skips that branch.
    """
    columns = target.columns
    missing = [name for name in columns if name not in source.columns]
    if missing:
        raise ValueError(f"source lacks the target's columns {missing}")
    if null_keys not in (INSERT, ABSENT):
        raise ValueError(f"null_keys must be {INSERT!r} or {ABSENT!r}")
    updated = [name for name in columns if name not in keys]
    if update_columns is not None:
        updated = list(update_columns)
    source = source.select(*[named(name) for name in columns])

    old, new = target, source
    if null_keys == INSERT:
        old, new = target.filter(_keyed(keys)), source.filter(_keyed(keys))
    old = old.withColumn("__in_target", F.lit(True)).alias("old")
    new = _one_row_per_key(new, keys).alias("new")

    def side(name: str, column: str) -> Column:
        return F.col(f"{name}.`{column}`")

    matches = reduce(Column.__and__, [side("old", key) == side("new", key) for key in keys])

    def merged(column: str) -> Column:
        before, after = side("old", column), side("new", column)
        if column in keys:
            value = F.coalesce(before, after)
        elif column in updated:
            value = F.when(F.col("__in_source"), after).otherwise(before)
        else:
            value = F.when(F.col("__in_target"), before).otherwise(after)
        return value.alias(column)

    # Always true, but it keeps the repeat check in the plan when columns are pruned.
    checked = F.coalesce(F.col("__in_source"), F.lit(True))
    result = (
        old.join(new, matches, "full_outer")
        .filter(checked)
        .select(*[merged(name) for name in columns])
    )
    if null_keys == INSERT:
        result = result.unionByName(target.filter(~_keyed(keys))).unionByName(
            source.filter(~_keyed(keys))
        )
    return result
