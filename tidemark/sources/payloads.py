"""Landed JSON payloads: one nested document per entity and poll."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.scalars import epoch_to_string, load_stamp, named


def read_payloads(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """``(city, payload)`` rows from text files below ``path/city=<name>/``.

    The city is the requested key, so it comes from the folder and never from
    the document. ``whole_files`` reads pretty-printed documents, one per file.
    """
    schema = "payload string, city string"
    return (
        spark.read.schema(schema)
        .text(path, wholetext=whole_files)
        .select("city", "payload")
    )


def parsed(text: Column, schema: T.StructType | str) -> Column:
    """Columns of a JSON document under a declared schema, parsed once.

    Malformed text and NULL give a row of NULLs. The columns come out of a
    generator because filters move below a projection and would parse every
    document again there; they do not move below a generator.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def _as_text(schema: T.StructType) -> T.StructType:
    """The same fields, each as the text that the document has for it."""
    return T.StructType([T.StructField(entry.name, T.StringType()) for entry in schema.fields])


def type_faults(text: Column, schema: T.StructType, typed: Callable[[str], Column]) -> Column:
    """The fields of a JSON document that hold something which their declared type does not
    take, as an array of names; ``typed`` gives the column a field was parsed into.

    The document is parsed once more with every field as text: a field that has a text and no
    value is at fault. Objects are looked into, arrays are judged whole. A JSON null, a missing
    field and a malformed document are no faults.
    """
    raw = F.from_json(text, _as_text(schema))
    faults: list[Column] = []
    for entry in schema.fields:
        own, value = raw[entry.name], typed(entry.name)
        faults.append(F.when(own.isNotNull() & value.isNull(), F.lit(entry.name)))
        if isinstance(entry.dataType, T.StructType):
            inner = F.from_json(own, _as_text(entry.dataType))
            faults += [
                F.when(
                    value.isNotNull() & inner[child.name].isNotNull() & value[child.name].isNull(),
                    F.lit(f"{entry.name}.{child.name}"),
                )
                for child in entry.dataType.fields
            ]
    return F.array_compact(F.array(*faults))


def payload_faults() -> Column:
    """:func:`type_faults` of parsed payloads beside their ``payload``. Only documents of which
    some field has no value are parsed once more."""
    schema = T._parse_datatype_string(schemas.PAYLOAD_DDL)
    leaves = []
    for entry in schema.fields:
        inner = entry.dataType.fields if isinstance(entry.dataType, T.StructType) else []
        leaves += [F.col(f"{entry.name}.{child.name}") for child in inner] or [F.col(entry.name)]
    some_missing = reduce(Column.__or__, [leaf.isNull() for leaf in leaves])
    none = F.array().cast("array<string>")
    faults = type_faults(F.col("payload"), schema, F.col)
    return F.when(some_missing, faults).otherwise(none)


def flatten_payloads(
    rows: DataFrame, as_of: datetime | str | None = None, keep_payload: bool = False
) -> DataFrame:
    """``(city, payload)`` to the ten typed input columns, and, when it is kept, ``payload``
    with its ``faults``: the names of fields that are not of their type, whose values are NULL.

    ``from_json`` reads an integer where a double is declared, and ``F.get``
    gives NULL for an empty ``weather`` array.
    """
    kept = ["payload", payload_faults().alias("faults")] if keep_payload else []
    source = ["payload"] if keep_payload else []
    documents = rows.select("city", *source, parsed(F.col("payload"), schemas.PAYLOAD_DDL))
    return documents.select(
        "city",
        *kept,
        F.col("main.temp").alias("temperature"),
        epoch_to_string(F.col("dt")).alias("timestamp"),
        load_stamp(as_of).alias("load_time"),
        F.get("weather", F.lit(0))["description"].alias("description"),
        epoch_to_string(F.col("sys.sunrise")).alias("sunrise"),
        F.col("wind.speed").alias("windspeed"),
        "timezone",
        F.col("sys.country").alias("countrycode"),
        F.col("main.humidity").alias("humidity"),
    )


def typed_batch(
    documents: DataFrame, column: str, schema: T.StructType | str, faults: str | None = None
) -> DataFrame:
    """JSON objects under a declared schema.

    Fields are matched by name: a missing one is NULL, an extra one is dropped. One that is not
    of its type is NULL, too, and named in the array ``faults``, a column of that name, if asked.
    """
    if faults is None:
        return documents.select(parsed(named(column), schema))
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rows = documents.select(named(column).alias("__document"), parsed(named(column), declared))
    found = type_faults(F.col("__document"), declared, named)
    return rows.select(*map(named, declared.names), found.alias(faults))
