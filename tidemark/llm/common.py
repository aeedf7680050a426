"""Column expressions and staging that the operators of this folder share."""

from __future__ import annotations

import contextlib
import ctypes
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import delete_path, fresh_folder

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Runs of anything but ASCII white space. Java tests a class of single characters with one
#: look into a table, a class of ranges with a test for each range.
WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"


#: What operators keep in a Python worker between tasks, by operator: a call lets go of it and
#: says whether there was anything.
_KEPT: dict[str, Callable[[], bool]] = {}
#: Lists of the folders that :func:`staged` writes, the innermost :func:`staging` last.
_SCOPES: list[list[str]] = []


def keeps(operator: str, release: Callable[[], bool]) -> None:
    """Registers how to let go of what ``operator`` keeps in a worker."""
    _KEPT[operator] = release


def enter(operator: str) -> None:
    """Called by a task: a worker that served another operator before gives its memory back."""
    dropped = [release() for other, release in _KEPT.items() if other != operator]
    if any(dropped):
        trim()


def trim() -> None:
    """A worker gives the memory back that it has freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def shrink_heaps(spark: SparkSession) -> None:
    """Executors collect their garbage and give the memory back that their heaps have grown by.

    A job of a short task for each core. An executor that gets none of them keeps its heap as
    it is: this is to spare memory between two steps, no result depends on it.
    """
    cores = spark.sparkContext.defaultParallelism
    collect = F.reflect(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, cores, 1, cores).select(collect).collect()


BATCH_SETTING, USUAL_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of BATCH_ROWS rows, unless the session has a number of its
    own: buffers of Spark's usual number of long texts stay in the executors' memory."""
    if spark.conf.get(BATCH_SETTING) == USUAL_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


@contextlib.contextmanager
def staging() -> Iterator[list[str]]:
    """Gathers the folders that operators stage meanwhile."""
    folders: list[str] = []
    _SCOPES.append(folders)
    try:
        yield folders
    finally:
        _SCOPES.remove(folders)


def forget(spark: SparkSession, folders: list[str]) -> None:
    """Deletes staged folders. Only for whoever has written all results that are read from
    them, as a pipeline has between two stages."""
    while folders:
        delete_path(spark, folders.pop())


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for what an operator writes on its way."""
    path = fresh_folder(spark, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def staged(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Cuts the lineage: what reads the result survives a lost executor without
    computing ``frame`` again, and Spark plans with the size of the files.
    """
    path = scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z alone lower-cased; ASCII texts take the quick way."""
    rest = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(rest)


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*columns: Column) -> Column:
    """A key of a row's values: rows with equal values share it, nulls have their own."""
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))
