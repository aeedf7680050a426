"""The tables of one pipeline below one root folder, written so that runs can be repeated.

Bronze is partitioned by the UTC date of the event, then by acceptance (rows without a key
or an event time are kept apart, with their raw payload and the reason) and by slice. A
slice is one increment and has a name of its own that no other batch ever uses.

A slice is pending from before its write until its mark has moved. What an interrupted
run left behind is found there: a slice that was not written whole is removed, one that
was is finished before anything new begins.

The control table keeps one small file per generation; the newest one counts, and all but
the last few are removed.

Silver is partitioned by UTC date. An upsert reads only the dates it touches and writes
each of them as a folder of a new version; a small snapshot file, written last, says which
version of each date counts. Readers take one snapshot and see a merge whole or not at all.
The last few snapshots and their folders stay, for readers that began earlier. There is
one writer at a time.

Which dates a slice touches is found by a glob over the names of bronze's date folders; their
files are not listed. Silver's dates are known from its snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.scalars import utc
from tidemark.operators.enrich import rejection
from tidemark.operators.increment import ENTITY_MARK, advance_control, lookup_mark
from tidemark.operators.upsert import ABSENT, upsert
from tidemark.shared import (
    child_names,
    delete_path,
    is_complete,
    matching_paths,
    path_exists,
    read_text,
    small_frame,
    write_text,
)


@dataclass(frozen=True)
class Layout:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def state(self) -> str:
        """Pending slices and the last slice of each source."""
        return f"{self.root}/state"

    @property
    def runlog(self) -> str:
        return f"{self.root}/runlog"


def _read_folders(
    spark: SparkSession, base: str, folders: Sequence[str], schema: T.StructType
) -> DataFrame:
    """Some partition folders of the table at ``base``; empty for none."""
    if not folders:
        return small_frame(spark, [], schema)
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*folders)


# --- slices in progress ------------------------------------------------------

STARTED, WRITTEN = "started", "written"


def new_slice(generation: int) -> str:
    """A name that no other batch has, in the order of runs."""
    return f"run-{generation:08d}-{uuid.uuid4().hex[:8]}"


def set_pending(spark: SparkSession, layout: Layout, name: str, **facts) -> None:
    write_text(spark, f"{layout.state}/pending/{name}.json", json.dumps(facts))


def forget_pending(spark: SparkSession, layout: Layout, name: str) -> None:
    delete_path(spark, f"{layout.state}/pending/{name}.json")


def pending_slices(spark: SparkSession, layout: Layout) -> dict[str, dict]:
    """Slices whose run has not ended, oldest first, with what their run had noted."""
    folder = f"{layout.state}/pending"
    names = [n for n in child_names(spark, folder) if n.endswith(".json")]
    return {n[: -len(".json")]: json.loads(read_text(spark, f"{folder}/{n}")) for n in names}


def read_source(spark: SparkSession, layout: Layout, source: str) -> dict:
    """What is known of a source after its last slice; empty before the first."""
    return json.loads(read_text(spark, f"{layout.state}/sources/{source}.json") or "{}")


def write_source(spark: SparkSession, layout: Layout, source: str, **facts) -> None:
    write_text(spark, f"{layout.state}/sources/{source}.json", json.dumps(facts))


# --- control table -----------------------------------------------------------


KEPT_GENERATIONS = 3


def latest_generation(spark: SparkSession, layout: Layout) -> int:
    """Number of the newest complete control file; 0 when there is none."""
    numbers = [int(name.split("=")[1]) for name in child_names(spark, layout.control)]
    for number in sorted(numbers, reverse=True):
        if is_complete(spark, f"{layout.control}/generation={number}"):
            return number
    return 0


def read_control(spark: SparkSession, layout: Layout, generation: int) -> DataFrame:
    if generation == 0:
        return small_frame(spark, [], schemas.CONTROL)
    return spark.read.schema(schemas.CONTROL).parquet(f"{layout.control}/generation={generation}")


def read_mark(spark: SparkSession, layout: Layout, table_name: str, generation: int):
    return lookup_mark(read_control(spark, layout, generation), table_name)


def write_mark(
    spark: SparkSession, layout: Layout, table_name: str, mark: str | None, generation: int
) -> None:
    """End ``generation`` and start the next; other tables' rows are carried over."""
    control = read_control(spark, layout, generation)
    if mark is not None:
        control = advance_control(control, table_name, mark)
    path = f"{layout.control}/generation={generation + 1}"
    control.coalesce(1).write.mode("overwrite").parquet(path)
    for number in range(generation + 1 - KEPT_GENERATIONS, 0, -1):
        expired = f"{layout.control}/generation={number}"
        if not path_exists(spark, expired):
            break
        delete_path(spark, expired)


# --- marks of entities and landed files, by slice --------------------------------

ENTITY = "city"
ENTITY_MARKS = T.StructType().add(ENTITY, "string").add(ENTITY_MARK, "string")
LANDED = T.StructType().add("path", "string").add("length", "long").add("slice", "string")
#: Slices of a source whose marks stay, for runs and batches that are done again.
KEPT_MARKS = 4


def _marks_folder(layout: Layout, name: str) -> str:
    return f"{layout.state}/entity_marks/{name}"


def read_entity_marks(spark: SparkSession, layout: Layout, name: str | None) -> DataFrame | None:
    """The mark of each entity as of a slice; None if none were kept then."""
    folder = _marks_folder(layout, name or "")
    if name is None or not is_complete(spark, folder):
        return None
    return spark.read.schema(ENTITY_MARKS).parquet(folder)


def write_entity_marks(marks: DataFrame, layout: Layout, name: str) -> None:
    folder = _marks_folder(layout, name)
    marks.select(*ENTITY_MARKS.names).write.mode("overwrite").parquet(folder)


def forget_entity_marks(spark: SparkSession, layout: Layout, names: Sequence[str]) -> None:
    for name in names:
        delete_path(spark, _marks_folder(layout, name))


def _landed_folder(layout: Layout) -> str:
    return f"{layout.state}/landed"


def read_landed(spark: SparkSession, layout: Layout) -> DataFrame:
    """The files that slices were made of: ``path``, ``length``, ``slice``."""
    if not child_names(spark, _landed_folder(layout)):
        return small_frame(spark, [], LANDED)
    return spark.read.schema(LANDED).parquet(_landed_folder(layout))


def write_landed(files: DataFrame, layout: Layout, name: str) -> None:
    """Note which files (``path``, ``length``) a slice is made of."""
    chosen = files.select("path", "length").coalesce(1)
    chosen.write.mode("overwrite").parquet(f"{_landed_folder(layout)}/slice={name}")


def forget_landed(spark: SparkSession, layout: Layout, name: str) -> None:
    delete_path(spark, f"{_landed_folder(layout)}/slice={name}")


# --- bronze ------------------------------------------------------------------

BRONZE_PARTITIONS = ("event_date", "accepted", "slice")
STORED_BRONZE = (
    T.StructType(list(schemas.BRONZE.fields))
    .add("payload", "string")
    .add("reason", "string")
    .add("event_date", "date")
    .add("accepted", "boolean")
    .add("slice", "string")
)
REJECTED = ("city", "payload", "reason", "slice")
#: Footers that the driver reads at a time.
SCHEMA_READERS = 16


def slice_folders(
    spark: SparkSession, layout: Layout, name: str, accepted: str = "true"
) -> list[str]:
    pattern = f"{layout.bronze}/event_date=*/accepted={accepted}/slice={name}"
    return matching_paths(spark, pattern)


def holds_only(spark: SparkSession, layout: Layout, name: str) -> bool:
    """Whether the accepted rows of bronze are all in one slice."""
    return slice_folders(spark, layout, "*") == slice_folders(spark, layout, name)


def remove_slice(spark: SparkSession, layout: Layout, name: str) -> None:
    """Remove what a write of this slice, and of no other, has left."""
    for folder in slice_folders(spark, layout, name, accepted="*"):
        delete_path(spark, folder)


def write_slice(rows: DataFrame, layout: Layout, name: str) -> None:
    """Write one increment in one pass, accepted and rejected rows side by side.

    ``rows`` are bronze rows with their ``payload``, which only rejected rows keep, and with
    its ``faults`` if those are known. The rebalance hint spreads rows evenly, so that no date
    and no city is one task's work.
    """
    reason = rejection(F.col("faults") if "faults" in rows.columns else None)
    (
        rows.select(
            *schemas.BRONZE.names,
            F.when(reason.isNotNull(), F.col("payload")).alias("payload"),
            reason.alias("reason"),
            F.to_date(utc(F.col("event_time"))).alias("event_date"),
            reason.isNull().alias("accepted"),
            F.lit(name).alias("slice"),
        )
        .hint("rebalance")
        .write.partitionBy(*BRONZE_PARTITIONS)
        .mode("append")
        .parquet(layout.bronze)
    )


def read_bronze(spark: SparkSession, layout: Layout) -> DataFrame:
    rows = spark.read.schema(STORED_BRONZE).parquet(layout.bronze)
    return rows.filter("accepted").select(*schemas.BRONZE.names)


def read_other_slices(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The accepted rows of all slices but one."""
    rows = spark.read.schema(STORED_BRONZE).parquet(layout.bronze)
    others = rows.filter(F.col("accepted") & (F.col("slice") != name))
    return others.select(*schemas.BRONZE.names)


def holds_rows(spark: SparkSession, layout: Layout, name: str) -> bool:
    """Whether a slice has any row, accepted or not."""
    return bool(slice_folders(spark, layout, name, accepted="*"))


def read_rejected(spark: SparkSession, layout: Layout, name: str = "*") -> DataFrame:
    """The quarantine: raw payloads that no hour and no key can hold, and why."""
    folders = slice_folders(spark, layout, name, accepted="false")
    return _read_folders(spark, layout.bronze, folders, STORED_BRONZE).select(*REJECTED)


def slice_counts(spark: SparkSession, layout: Layout, name: str) -> tuple[str | None, int, int]:
    """The newest timestamp of a slice's accepted rows, their number, and that of rejected ones,
    from one pass over what was written."""
    folders = slice_folders(spark, layout, name, accepted="*")
    rows = _read_folders(spark, layout.bronze, folders, STORED_BRONZE)
    accepted = F.col("accepted")
    return rows.agg(
        F.max(F.when(accepted, F.col("timestamp"))), F.count_if(accepted), F.count_if(~accepted)
    ).first()


def read_slice(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The accepted rows of one increment."""
    folders = slice_folders(spark, layout, name)
    rows = _read_folders(spark, layout.bronze, folders, STORED_BRONZE)
    return rows.select(*schemas.BRONZE.names)


def _schema_of(spark: SparkSession, folder: str) -> T.StructType:
    return spark.read.parquet(folder).schema


def _by_schema(spark: SparkSession, folders: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Folders grouped by the schema that their files have. Each folder was filled by one
    write, so one of its files tells; a footer is read for each, several at a time."""
    if not folders:
        return []
    with ThreadPoolExecutor(SCHEMA_READERS) as pool:
        schemas_of = list(pool.map(lambda folder: _schema_of(spark, folder), folders))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, folder in zip(schemas_of, folders, strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].append(folder)
    return list(groups.values())


def as_stored(
    spark: SparkSession, layout: Layout, name: str = "*", folders: Sequence[str] | None = None
) -> DataFrame:
    """Accepted rows, of one slice or of some folders, under the schema that their files have,
    as checks of the schema need it.

    Without any row there is no file to tell, and the declared schema stands in.
    """
    folders = slice_folders(spark, layout, name) if folders is None else folders
    if not folders:
        return small_frame(spark, [], schemas.BRONZE)
    return spark.read.parquet(*folders).drop("payload", "reason")


def stored_parts(spark: SparkSession, layout: Layout) -> list[DataFrame]:
    """All accepted rows, in one part for each schema that slices have been stored with."""
    groups = _by_schema(spark, slice_folders(spark, layout, "*"))
    return [as_stored(spark, layout, "*", folders) for _, folders in groups or [(None, [])]]


def read_dates_of_slice(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """All accepted rows of the dates on which a slice has rows, and of no other date."""
    dates = [path.rsplit("/", 1)[0] for path in slice_folders(spark, layout, name)]
    rows = _read_folders(spark, layout.bronze, dates, STORED_BRONZE)
    return rows.select(*schemas.BRONZE.names)


# --- silver ------------------------------------------------------------------

SILVER_PARTITION, VERSION = "hour_date", "version"
STORED_SILVER = (
    T.StructType(list(schemas.SILVER.fields)).add(SILVER_PARTITION, "date").add(VERSION, "string")
)
#: Snapshots that readers may still be at.
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Snapshot:
    """Which version of each date makes up the silver table; names of folders both."""

    number: int = 0
    dates: Mapping[str, str] = field(default_factory=dict)

    def folders(self, path: str, dates: Sequence[str] | None = None) -> list[str]:
        chosen = sorted(self.dates) if dates is None else dates
        return [f"{path}/{date}/{self.dates[date]}" for date in chosen]

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "dates": dict(self.dates)})


def _snapshot_numbers(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, f"{path}/_versions")
    return sorted(int(name[: -len(".json")]) for name in names if name[:-len(".json")].isdigit())


def _read_snapshot(spark: SparkSession, file: str) -> Snapshot | None:
    text = read_text(spark, file)
    return None if text is None else Snapshot(**json.loads(text))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest snapshot, or that of ``version``; empty before the first merge."""
    numbers = _snapshot_numbers(spark, path)
    if version is None and not numbers:
        return Snapshot()
    if version is not None and version not in numbers:
        raise ValueError(f"version {version} of {path} is not kept; there are {numbers}")
    number = numbers[-1] if version is None else version
    return _read_snapshot(spark, f"{path}/_versions/{number:010d}.json")


def read_silver(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The silver table as of the newest or a given, still kept, version."""
    folders = snapshot(spark, path, version).folders(path)
    return _read_folders(spark, path, folders, STORED_SILVER).select(*schemas.SILVER.names)


def _dates(spark: SparkSession, path: str) -> list[str]:
    return [name for name in child_names(spark, path) if name.startswith(f"{SILVER_PARTITION}=")]


def _staged(path: str) -> str:
    return f"{path}_updates"


def silver_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    """The silver table in one part for each schema that its dates have been stored with. No
    date, and so no key, is in two parts."""
    groups = _by_schema(spark, snapshot(spark, path).folders(path))
    if not groups:
        return [small_frame(spark, [], schemas.SILVER)]
    return [spark.read.parquet(*folders) for _, folders in groups]


def staged_as_stored(spark: SparkSession, path: str) -> DataFrame:
    """The staged updates under the schema that their files have."""
    if not _dates(spark, _staged(path)):
        return small_frame(spark, [], schemas.SILVER)
    return spark.read.parquet(_staged(path)).drop(SILVER_PARTITION)


def read_changed_dates(spark: SparkSession, path: str, known: set[str]) -> DataFrame:
    """The silver rows, with their date, of the dates that the staged updates touched and of
    those not among the ``known`` folder names; under the schema that the files have."""
    current, updated = snapshot(spark, path), set(_dates(spark, _staged(path)))
    changed = [date for date in sorted(current.dates) if date in updated or date not in known]
    if not changed:
        return small_frame(spark, [], STORED_SILVER).drop(VERSION)
    reader = spark.read.option("basePath", path)
    return reader.parquet(*current.folders(path, changed)).drop(VERSION)


def _write_dates(rows: DataFrame, path: str, mode: str, version: str | None = None) -> None:
    dated = rows.withColumn(SILVER_PARTITION, F.to_date(utc(F.col("hour_start"))))
    partitions = [SILVER_PARTITION]
    if version is not None:
        dated, partitions = dated.withColumn(VERSION, F.lit(version)), [SILVER_PARTITION, VERSION]
    dated.hint("rebalance").write.partitionBy(*partitions).mode(mode).parquet(path)


def _publish(spark: SparkSession, path: str, new: Snapshot) -> None:
    """Make ``new`` the table, by one file."""
    write_text(spark, f"{path}/_versions/{new.number:010d}.json", new.to_json())


def _finish_pending(spark: SparkSession, path: str) -> None:
    """Publish a snapshot whose folders are all written, also one that an interrupted run left,
    and let go of versions that are no longer kept."""
    pending = f"{path}/_versions/pending.json"
    new = _read_snapshot(spark, pending)
    if new is None:
        return
    if new.number not in _snapshot_numbers(spark, path):
        _publish(spark, path, new)
    _expire(spark, path)
    delete_path(spark, pending)


def _expire(spark: SparkSession, path: str) -> None:
    numbers = _snapshot_numbers(spark, path)
    held = {
        folder
        for number in numbers[-KEPT_VERSIONS:]
        for folder in snapshot(spark, path, number).folders(path)
    }
    for number in numbers[:-KEPT_VERSIONS]:
        for folder in snapshot(spark, path, number).folders(path):
            if folder not in held:
                delete_path(spark, folder)
        delete_path(spark, f"{path}/_versions/{number:010d}.json")


def stage_updates(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """Write the source of a merge next to its table and read it back.

    Whatever is done with it afterwards, checks and the merge, reads the stored
    rows and does not compute the source again.
    """
    _write_dates(source.select(*schemas.SILVER.names), _staged(path), "overwrite")
    return _read_staged(spark, path)


def _read_staged(spark: SparkSession, path: str) -> DataFrame:
    stored = STORED_SILVER[: len(schemas.SILVER.names) + 1]
    return spark.read.schema(stored).parquet(_staged(path)).select(*schemas.SILVER.names)


def merge_staged(
    spark: SparkSession, path: str, update_columns: Sequence[str] = schemas.SILVER_MEASURES
) -> list[str]:
    """Upsert the staged updates into the silver table, or create the table from them, and
    return the dates it rewrote, as names of folders.

    The merged dates are written as a version of their own, which nobody reads until its
    snapshot is published. Should the driver stop before that, the folders are left and
    never read; should it stop while publishing, the next merge publishes first. Nothing is
    lost and nothing is merged twice.
    """
    _finish_pending(spark, path)
    current, dates = snapshot(spark, path), _dates(spark, _staged(path))
    if not dates:
        return []
    merged = _read_staged(spark, path)
    touched = [date for date in dates if date in current.dates]
    if touched:
        target = _read_folders(spark, path, current.folders(path, touched), STORED_SILVER)
        merged = upsert(
            target.select(*schemas.SILVER.names),
            merged,
            keys=schemas.SILVER_KEYS,
            update_columns=update_columns,
            null_keys=ABSENT,
        )
    number = current.number + 1
    version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    _write_dates(merged, path, "append", version)
    rewritten = dict.fromkeys(dates, f"{VERSION}={version}")
    new = Snapshot(number, {**current.dates, **rewritten})
    write_text(spark, f"{path}/_versions/pending.json", new.to_json())
    _finish_pending(spark, path)
    return dates


def merge_into_silver(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    update_columns: Sequence[str] = schemas.SILVER_MEASURES,
) -> None:
    stage_updates(spark, path, source)
    merge_staged(spark, path, update_columns)
