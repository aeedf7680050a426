import json

from pyspark.sql import functions as F

from helpers import document, payload_frame, plan_of, sorted_rows
from tidemark import schemas
from tidemark.operators import enrich
from tidemark.operators.enrich import (
    dictionary_lookup,
    is_acceptable,
    to_bronze,
)
from tidemark.sources.payloads import flatten_payloads, read_payloads, typed_batch

AS_OF = "2024-02-01 00:00:00"


def test_flatten_reads_nested_fields_and_takes_city_from_the_request(spark):
    text = json.loads(document("2024-01-01 10:20:30", temp=7, country="JP", offset=32400))
    text["name"] = "Somewhere Else"
    rows = flatten_payloads(payload_frame(spark, [("Tokyo", json.dumps(text))]), AS_OF)
    assert rows.schema == schemas.INPUT or rows.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.INPUT.fields
    ]
    assert rows.first().asDict() == {
        "city": "Tokyo",
        "temperature": 7.0,
        "timestamp": "2024-01-01 10:20:30",
        "load_time": AS_OF,
        "description": "clear sky",
        "sunrise": "2024-01-01 06:00:00",
        "windspeed": 3.0,
        "timezone": 32400,
        "countrycode": "JP",
        "humidity": 50,
    }


def test_flatten_survives_bad_documents(spark):
    empty_weather = json.loads(document("2024-01-01 10:00:00"))
    empty_weather["weather"] = []
    rows = [
        ("A", "not json"),
        ("B", json.dumps({"cod": 404, "message": "city not found"})),
        ("C", json.dumps(empty_weather)),
        ("D", None),
    ]
    got = {r["city"]: r for r in flatten_payloads(payload_frame(spark, rows), AS_OF).collect()}
    assert len(got) == 4
    assert got["A"]["timestamp"] is None and got["B"]["temperature"] is None
    assert got["C"]["description"] is None and got["C"]["timestamp"] == "2024-01-01 10:00:00"


def test_read_payloads_takes_city_from_the_folder(spark, tmp_path):
    folder = tmp_path / "landed"
    for city in ("London", "New York"):
        (folder / f"city={city}").mkdir(parents=True)
        (folder / f"city={city}" / "one.json").write_text(document("2024-01-01 10:00:00") + "\n")
    rows = read_payloads(spark, str(folder))
    assert {r["city"] for r in rows.collect()} == {"London", "New York"}

    pretty = tmp_path / "pretty" / "city=Tokyo"
    pretty.mkdir(parents=True)
    text = json.dumps(json.loads(document("2024-01-01 11:00:00")), indent=2)
    (pretty / "one.json").write_text(text)
    whole = read_payloads(spark, str(tmp_path / "pretty"), whole_files=True)
    assert flatten_payloads(whole, AS_OF).first()["timestamp"] == "2024-01-01 11:00:00"


def test_typed_batch_matches_by_name(spark):
    documents = spark.createDataFrame(
        [('{"b": 7, "a": "x", "extra": 1}',), ('{"a": "y"}',)], "doc string"
    )
    got = typed_batch(documents, "doc", "a string, b double")
    assert [tuple(r) for r in got.collect()] == [("x", 7.0), ("y", None)]


def test_typed_batch_names_what_is_not_of_its_type(spark):
    documents = spark.createDataFrame(
        [('{"a": "x", "b": "7", "c": {"d": "no"}}',), ('{"a": 5, "b": 7.5, "c": 1}',), ("broken",),
         ('{"b": null}',), (None,)], "doc string",
    )
    got = typed_batch(documents, "doc", "a string, b double, c struct<d: int>", faults="wrong")
    assert [(r["a"], r["b"], r["wrong"]) for r in got.collect()] == [
        ("x", None, ["b", "c.d"]), ("5", 7.5, ["c"]), (None, None, []), (None, None, []), (None, None, []),
    ]


def test_dictionary_lookup_defaults_and_never_multiplies(spark):
    rows = spark.createDataFrame([(1, "GB"), (2, "XX"), (3, None), (4, "GB")], "id int, cc string")
    names = spark.createDataFrame(
        [("GB", "Britain"), ("GB", "United Kingdom"), (None, "Nowhere")], "code string, name string"
    )
    got = dictionary_lookup(rows, "cc", names, "code", "name", "country").orderBy("id")
    assert [r["country"] for r in got.collect()] == [
        "United Kingdom",
        "Unknown",
        "Unknown",
        "United Kingdom",
    ]


def test_planning_a_lookup_runs_no_job(spark):
    names = spark.range(3).select(
        F.raise_error(F.lit("read while planning")).cast("string").alias("code"),
        F.lit("x").alias("name"),
    )
    rows = spark.range(3).select(F.col("id").cast("string").alias("cc"))
    assert dictionary_lookup(rows, "cc", names, "code", "name", "country").columns == ["cc", "country"]


def test_the_lookup_is_the_same_without_a_broadcast(spark):
    cold = (F.col("id") % 50).cast("string")
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(cold).alias("cc")
    )
    names = spark.range(40).select(F.col("id").cast("string").alias("code"))
    names = names.union(spark.sql("select 'hot'")).select("code", F.upper("code").alias("name"))
    small = dictionary_lookup(rows, "cc", names, "code", "name", "country")
    expected = sorted_rows(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = dictionary_lookup(rows, "cc", names, "code", "name", "country")
        assert "SortMergeJoin" in plan_of(large)
        assert sorted_rows(large) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bronze_has_the_declared_columns(spark, countries):
    rows = [
        ("London", document("2024-01-31 23:59:59", offset=-1800)),
        ("Paris", document(None, country="FR")),
    ]
    inputs = flatten_payloads(payload_frame(spark, rows), AS_OF)
    bronze = to_bronze(inputs, countries)
    assert bronze.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.BRONZE.fields]
    london, paris = sorted(bronze.collect(), key=lambda r: r["city"])
    assert (london["timeZone"], london["country"]) == ("UTC-00:30", "United Kingdom")
    assert (london["year"], london["month"]) == (2024, 1)
    assert paris["country"] == "Unknown" and paris["year"] is None
    assert [r["city"] for r in bronze.filter(is_acceptable()).collect()] == ["London"]
