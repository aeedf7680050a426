"""The tables of a pipeline under names, in a database of Spark's catalog.

Tables are external: the catalog holds their schemas and where each partition lies, the
files stay with the pipeline. A merge gives the dates it rewrote a new place; readers by
name see the newest snapshot, readers by path may ask for an older one.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.plans import store
from tidemark.plans.store import Layout

if TYPE_CHECKING:
    from tidemark.plans.refresh import RunSummary

BRONZE, SILVER, CONTROL = "bronze", "silver", "control"


def table_exists(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(name)}")


def read_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table by its name, without the columns that only say where its files lie."""
    rows = spark.table(f"{_quoted(database)}.{_quoted(name)}")
    if name == BRONZE:
        return rows.filter("accepted").select(*schemas.BRONZE.names)
    return rows.select(*schemas.SILVER.names) if name == SILVER else rows


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _create(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partitions: tuple[str, ...]
) -> None:
    by = f" PARTITIONED BY ({', '.join(map(_quoted, partitions))})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING parquet{by} "
        f"LOCATION {_text(path)}"
    )


def _partition(folder: str, names: tuple[str, ...]) -> str:
    """The values in the names of a folder as a partition of a statement."""
    values = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
    return ", ".join(f"{_quoted(name)} = {_text(values[name])}" for name in names)


def _place(spark: SparkSession, table: str, places: dict[str, str], known: set[str]) -> None:
    """Give partitions (as statements name them) their folders, in as few statements as can be."""
    fresh = {part: path for part, path in places.items() if part not in known}
    if fresh:
        added = " ".join(f"PARTITION ({p}) LOCATION {_text(path)}" for p, path in fresh.items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for part in places.keys() & known:
        spark.sql(f"ALTER TABLE {table} PARTITION ({part}) SET LOCATION {_text(places[part])}")


def _known(spark: SparkSession, table: str, names: tuple[str, ...]) -> set[str]:
    shown = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {_partition(row[0], names) for row in shown}


def register(
    spark: SparkSession, layout: Layout, database: str, summary: RunSummary | None = None
) -> None:
    """Make the catalog show what the pipeline holds: create what is not there, add the
    partitions of the last run's slice and move the dates that merges rewrote.

    Without the ``summary`` of a run every slice is added, which also mends a catalog that a
    stopped run, or another session, has left behind.
    """
    place = _text(f"{layout.root}/catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION {place}")
    name = lambda table: f"{_quoted(database)}.{_quoted(table)}"

    bronze_by = store.BRONZE_PARTITIONS
    if not table_exists(spark, database, BRONZE):
        summary = None
    _create(spark, name(BRONZE), store.STORED_BRONZE, layout.bronze, bronze_by)
    folders = store.slice_folders(
        spark, layout, "*" if summary is None else summary.slice_name, accepted="*"
    )
    _place(spark, name(BRONZE), {_partition(f, bronze_by): f for f in folders}, set())

    silver_by = (store.SILVER_PARTITION,)
    schema = T.StructType([f for f in store.STORED_SILVER.fields if f.name != store.VERSION])
    _create(spark, name(SILVER), schema, layout.silver, silver_by)
    current = store.snapshot(spark, layout.silver)
    newest = {v for v in current.dates.values() if v.startswith(f"{store.VERSION}={current.number:010d}-")}
    known = _known(spark, name(SILVER), silver_by)
    places = {
        _partition(date, silver_by): f"{layout.silver}/{date}/{version}"
        for date, version in current.dates.items()
        if summary is None or version in newest or _partition(date, silver_by) not in known
    }
    _place(spark, name(SILVER), places, known)

    generation = store.latest_generation(spark, layout)
    if generation:
        path = f"{layout.control}/generation={generation}"
        _create(spark, name(CONTROL), schemas.CONTROL, path, ())
        spark.sql(f"ALTER TABLE {name(CONTROL)} SET LOCATION {_text(path)}")
    for table in (BRONZE, SILVER, CONTROL):
        if table_exists(spark, database, table):
            spark.catalog.refreshTable(name(table))


def unregister(spark: SparkSession, database: str) -> None:
    """Forget the names; external tables leave their files."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database)} CASCADE")
