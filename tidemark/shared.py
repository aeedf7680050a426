"""Folders every executor can reach, and the few file-system calls tables need."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW_TYPES = {
    "string": pa.string(),
    "double": pa.float64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp": pa.timestamp("us", tz="UTC"),
    "array<string>": pa.list_(pa.string()),
}


@functools.lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall
    back to a temporary folder; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark job has finished writing to ``path``."""
    return path_exists(spark, f"{path}/_SUCCESS")


def delete_path(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; what is at ``target`` must be gone."""
    files, location = _file_system(spark, source)
    goal = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not files.rename(location, goal):
        raise OSError(f"cannot move {source} to {target}")


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, such as partition folders."""
    files, location = _file_system(spark, pattern)
    return sorted(str(status.getPath()) for status in files.globStatus(location) or [])


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written by the driver; appears whole or not at all."""
    files, location = _file_system(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files.delete(location, False)
    files.rename(draft, location)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None when there is none."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def small_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, which needs no job of its own."""
    arrow = pa.schema([(f.name, ARROW_TYPES[f.dataType.simpleString()]) for f in schema.fields])
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=arrow), schema)
