from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import sorted_rows
from tidemark.operators import increment

MARK = "2024-01-01 10:00:00"
ROWS = [
    ("a", "2024-01-01 09:00:00"),
    ("a", "2024-01-01 10:00:00"),
    ("a", "2024-01-01 11:00:00"),
    ("b", "2024-01-01 08:00:00"),
    ("b", None),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "city string, timestamp string")


def control(spark, rows):
    return spark.createDataFrame(rows, "TableName string, WatermarkValue string")


def test_above_mark_is_strict_and_drops_null(spark):
    kept = increment.above_mark(frame(spark), "timestamp", MARK)
    assert sorted_rows(kept) == [("a", "2024-01-01 11:00:00")]
    assert increment.above_mark(frame(spark), "timestamp", None).count() == 5


def test_late_rows_are_the_rest_with_a_time(spark):
    assert increment.late_rows(frame(spark), "timestamp", MARK).count() == 3
    assert increment.late_rows(frame(spark), "timestamp", None).count() == 0


def test_entity_marks_keep_slow_entities(spark):
    marks = spark.createDataFrame(
        [("a", MARK), ("c", MARK)], "city string, __mark string"
    )
    kept = increment.above_entity_marks(frame(spark), marks, ["city"], "timestamp")
    assert sorted_rows(kept) == [("a", "2024-01-01 11:00:00"), ("b", "2024-01-01 08:00:00")]


def test_lookup_and_advance(spark):
    table = control(spark, [("weather_data", MARK), ("other", "x")])
    assert increment.lookup_mark(table, "weather_data") == MARK
    assert increment.lookup_mark(table, "absent") is None
    assert sorted_rows(increment.advance_control(table, "weather_data", "z")) == [
        ("other", "x"),
        ("weather_data", "z"),
    ]
    first = increment.advance_control(control(spark, []), "weather_data", "z")
    assert sorted_rows(first) == [("weather_data", "z")]


def test_update_never_inserts(spark):
    table = control(spark, [("other", "x")])
    assert sorted_rows(increment.update_control(table, "weather_data", F.lit("z"))) == [
        ("other", "x")
    ]


def test_next_mark_keeps_the_old_one_for_an_empty_increment(spark):
    empty = frame(spark).filter(F.lit(False))
    assert increment.next_mark(empty, "timestamp").first()[0] is None
    assert increment.next_mark(empty, "timestamp", F.lit(MARK)).first()[0] == MARK
    assert increment.next_mark(frame(spark), "timestamp").first()[0] == "2024-01-01 11:00:00"


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(hours=st.lists(st.integers(0, 23), min_size=1, max_size=8, unique=True), cut=st.integers(0, 23))
def test_time_ordered_pieces_equal_one_ingest(spark, hours, cut):
    rows = [("a", f"2024-01-01 {h:02d}:00:00") for h in hours]
    batch = frame(spark, rows)
    edge = f"2024-01-01 {cut:02d}:00:00"
    mark, seen = None, []
    for piece in (batch.filter(F.col("timestamp") <= edge), batch.filter(F.col("timestamp") > edge)):
        new = increment.above_mark(piece, "timestamp", mark)
        seen += sorted_rows(new)
        advanced = increment.next_mark(new, "timestamp", F.lit(mark).cast("string")).first()[0]
        assert mark is None or advanced >= mark
        mark = advanced
    assert sorted(seen) == sorted(rows)
