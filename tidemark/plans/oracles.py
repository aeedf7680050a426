"""Independent ANSI SQL for every registered query, for another engine to run."""

from __future__ import annotations

from tidemark import schemas
from tidemark.operators.expectations import type_name
from tidemark.plans import suites
from tidemark.plans.observations import AS_OF, CITY_OF
from tidemark.plans.queries import CUT, ORDERS_CUT, TYPES

STAMP = "'%Y-%m-%d %H:%M:%S'"
TWO_DIGITS = r"""'^\{"k": [0-9]{2}\}$'"""

OFFSET = "((user_id % 27 - 12) * 3600 + (user_id % 4) * 900)"


def _offset_label(offset: str) -> str:
    return (
        f"printf('UTC%s%02d:%02d', CASE WHEN {offset} < 0 THEN '-' ELSE '+' END, "
        f"abs({offset}) // 3600, (abs({offset}) % 3600) // 60)"
    )


def _half_up(value: str) -> str:
    """Two decimals, half up on the decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def _exact_mean(value: str) -> str:
    """Average of values with two decimals from an integer sum."""
    units = f"sum(CAST(round({value} * 100) AS BIGINT))"
    return f"CAST({units} AS DOUBLE) / 100 / count({value})"


_CITY = "CASE event_type " + " ".join(
    f"WHEN '{kind}' THEN '{city}'" for kind, city in CITY_OF.items()
) + " END"

INPUTS = f"""
SELECT {_CITY} AS city,
       value AS temperature,
       strftime(date_trunc('second', ts), {STAMP}) AS "timestamp",
       '{AS_OF}' AS load_time,
       event_type AS description,
       strftime(date_trunc('day', ts) + INTERVAL 6 HOUR, {STAMP}) AS sunrise,
       CAST(user_id % 300 AS DOUBLE) / 10 AS windspeed,
       {OFFSET} AS timezone,
       'N' || chr(CAST(65 + user_id % 27 AS INTEGER)) AS countrycode,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity
FROM events
"""

BRONZE = f"""
SELECT city, temperature, "timestamp", load_time, description, sunrise, windspeed,
       countrycode, humidity,
       {_offset_label("timezone")} AS "timeZone",
       CAST("timestamp" AS TIMESTAMP) AS event_time,
       coalesce(n_name, 'Unknown') AS country,
       CAST(year(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS year,
       CAST(month(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS month
FROM inputs LEFT JOIN nation ON countrycode = 'N' || chr(65 + n_nationkey)
"""

SILVER = f"""
SELECT city,
       date_trunc('hour', event_time) AS hour_start,
       date_trunc('hour', event_time) + INTERVAL 1 HOUR AS hour_end,
       {_half_up(_exact_mean("temperature"))} AS avg_temperature,
       {_half_up(_exact_mean("humidity"))} AS avg_humidity,
       {_half_up(_exact_mean("windspeed"))} AS avg_windspeed,
       max(temperature) AS max_temperature,
       count(*) AS record_count
FROM bronze GROUP BY city, date_trunc('hour', event_time)
"""

WITH_INPUTS = f"WITH inputs AS ({INPUTS})"
WITH_BRONZE = f"{WITH_INPUTS}, bronze AS ({BRONZE})"
WITH_SILVER = f"{WITH_BRONZE}, silver AS ({SILVER})"


def _hourly(mean: str, rows: str = "events", value: str = "value", where: str = "true") -> str:
    return f"""
SELECT event_type,
       date_trunc('hour', ts) AS hour_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end,
       {mean} AS avg_temperature,
       max({value}) AS max_temperature,
       count(*) AS record_count
FROM {rows} WHERE {where} GROUP BY event_type, date_trunc('hour', ts)
"""


STAMPED = f"""
SELECT *, CASE event_type WHEN 'error' THEN '2025-02-30 00:00:00'
                          WHEN 'view' THEN NULL
                          WHEN 'click' THEN '2025-1-1 0:0:0'
                          ELSE strftime(date_trunc('second', ts), {STAMP}) END AS stamp
FROM events
"""

LOG = f"""
SELECT event_id AS seq,
       '[' || strftime(date_trunc('second', ts), {STAMP}) || '] ['
           || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || '] '
           || event_type || ' by user ' || user_id AS value,
       date_trunc('second', ts) AS log_time,
       CAST(ts AS DATE) AS log_date,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       event_type || ' by user ' || user_id AS message
FROM events
"""


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_text(value) for value in values)


class _Rules:
    """SQL predicates for the rows that violate an expectation."""

    @staticmethod
    def in_set(column: str, values) -> str:
        return f'"{column}" NOT IN ({_in_list(values)})'

    @staticmethod
    def between(column: str, bounds) -> str:
        low, high = bounds["min_value"], bounds["max_value"]
        return f'NOT ("{column}" BETWEEN {low} AND {high})'

    @staticmethod
    def regex(column: str, pattern: str) -> str:
        return f'NOT regexp_matches("{column}", {_text(pattern)})'

    @staticmethod
    def strftime(column: str, pattern: str) -> str:
        return f'try_strptime("{column}", {_text(pattern)}) IS NULL'


def _map_row(kind: str, column: str, predicate: str, rows: str, seq: int) -> str:
    """One result row of a row-level expectation, counted over ``rows``."""
    return f"""
SELECT {seq} AS seq, {_text(kind)} AS expectation_type, {_text(column)} AS "column",
       wrong = 0 AS success, NULL::VARCHAR AS observed_value,
       el AS element_count, mi AS missing_count,
       CASE WHEN el > 0 THEN mi::DOUBLE * 100 / el END AS missing_percent,
       wrong AS unexpected_count,
       CASE WHEN el > mi THEN wrong::DOUBLE * 100 / (el - mi) END AS unexpected_percent,
       CASE WHEN el > 0 THEN wrong::DOUBLE * 100 / el END AS unexpected_percent_total,
       CASE WHEN el > mi THEN wrong::DOUBLE * 100 / (el - mi) END AS unexpected_percent_nonmissing,
       false AS raised_exception
FROM (SELECT count(*) AS el, count(*) FILTER (WHERE "{column}" IS NULL) AS mi,
             count(*) FILTER (WHERE "{column}" IS NOT NULL AND {predicate}) AS wrong FROM {rows})
"""


def _null_row(column: str, rows: str, seq: int) -> str:
    return f"""
SELECT {seq} AS seq, 'expect_column_values_to_not_be_null' AS expectation_type,
       {_text(column)} AS "column", wrong = 0 AS success, NULL::VARCHAR AS observed_value,
       el AS element_count, NULL::BIGINT AS missing_count, NULL::DOUBLE AS missing_percent,
       wrong AS unexpected_count,
       CASE WHEN el > 0 THEN wrong::DOUBLE * 100 / el END AS unexpected_percent,
       CASE WHEN el > 0 THEN wrong::DOUBLE * 100 / el END AS unexpected_percent_total,
       NULL::DOUBLE AS unexpected_percent_nonmissing, false AS raised_exception
FROM (SELECT count(*) AS el, count(*) FILTER (WHERE "{column}" IS NULL) AS wrong FROM {rows})
"""


def _compound_row(columns: list[str], rows: str, seq: int) -> str:
    keys = ", ".join(columns)
    empty = " AND ".join(f"{column} IS NULL" for column in columns)
    return f"""
SELECT {seq} AS seq, 'expect_compound_columns_to_be_unique' AS expectation_type,
       NULL::VARCHAR AS "column", wrong = 0 AS success, NULL::VARCHAR AS observed_value,
       el AS element_count, mi AS missing_count,
       CASE WHEN el > 0 THEN mi::DOUBLE * 100 / el END AS missing_percent,
       wrong AS unexpected_count,
       CASE WHEN el > mi THEN wrong::DOUBLE * 100 / (el - mi) END AS unexpected_percent,
       CASE WHEN el > 0 THEN wrong::DOUBLE * 100 / el END AS unexpected_percent_total,
       CASE WHEN el > mi THEN wrong::DOUBLE * 100 / (el - mi) END AS unexpected_percent_nonmissing,
       false AS raised_exception
FROM (SELECT coalesce(sum(c), 0)::BIGINT AS el,
             coalesce(sum(c) FILTER (WHERE {empty}), 0)::BIGINT AS mi,
             coalesce(sum(c) FILTER (WHERE c > 1 AND NOT ({empty})), 0)::BIGINT AS wrong
      FROM (SELECT {keys}, count(*) AS c FROM {rows} GROUP BY {keys}))
"""


def _verdict_row(kind: str, column: str | None, success: str, observed: str, seq: int,
                 source: str = "", raised: bool = False) -> str:
    return f"""
SELECT {seq} AS seq, {_text(kind)} AS expectation_type, {_text(column)} AS "column",
       {success} AS success, {observed} AS observed_value,
       NULL::BIGINT AS element_count, NULL::BIGINT AS missing_count,
       NULL::DOUBLE AS missing_percent, NULL::BIGINT AS unexpected_count,
       NULL::DOUBLE AS unexpected_percent, NULL::DOUBLE AS unexpected_percent_total,
       NULL::DOUBLE AS unexpected_percent_nonmissing, {str(raised).lower()} AS raised_exception
{source}
"""


NO_VALUE = "NULL::VARCHAR"

SUITE_OUTPUT = (
    'seq, expectation_type, success, "column", observed_value, element_count, missing_count, '
    "unexpected_count, unexpected_percent, raised_exception"
)

# Spark's name of each type that the tables have.
TYPE_NAMES = {
    "VARCHAR": "StringType",
    "DOUBLE": "DoubleType",
    "INTEGER": "IntegerType",
    "BIGINT": "LongType",
    "TIMESTAMP": "TimestampType",
}


def _described(rows: str) -> str:
    """The columns of ``rows`` with Spark's names of their types."""
    names = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_NAMES.items())
    return f"""SELECT column_name AS name, CASE column_type {names} END AS kind,
        row_number() OVER () AS place FROM (DESCRIBE {rows})"""


NAMES = """(SELECT '[' || string_agg('"' || name || '"', ', ' ORDER BY place) || ']' FROM described)"""


def _column_count(value: int, seq: int) -> str:
    count = "(SELECT count(*) FROM described)"
    kind = "expect_table_column_count_to_equal"
    return _verdict_row(kind, None, f"{count} = {value}", f"{count}::VARCHAR", seq)


def _ordered_columns(names: list[str], seq: int) -> str:
    wanted = "[" + ", ".join(f'"{name}"' for name in names) + "]"
    kind = "expect_table_columns_to_match_ordered_list"
    return _verdict_row(kind, None, f"{NAMES} = {_text(wanted)}", NAMES, seq)


def _exists(name: str, seq: int) -> str:
    found = f"{_text(name)} IN (SELECT name FROM described)"
    return _verdict_row("expect_column_to_exist", name, found, NO_VALUE, seq)


def _of_type(name: str, wanted: str, seq: int) -> str:
    kind = f"(SELECT kind FROM described WHERE name = {_text(name)})"
    success = f"{kind} = {_text(wanted)}"
    return _verdict_row("expect_column_values_to_be_of_type", name, success, kind, seq)


def _absent(kind: str, name: str, seq: int) -> str:
    """A check of a column that the table has not: it cannot be evaluated."""
    held = f"{_text(name)} IN (SELECT name FROM described)"
    return _verdict_row(kind, name, held, NO_VALUE, seq, raised=True)


def _suite_bronze() -> str:
    rows: list[str] = []
    low, high = suites.BRONZE_ROW_COUNT["min_value"], suites.BRONZE_ROW_COUNT["max_value"]
    rows.append(
        _verdict_row(
            "expect_table_row_count_to_be_between",
            None,
            f"count(*) BETWEEN {low} AND {high}",
            "count(*)::VARCHAR",
            0,
            "FROM bronze",
        )
    )
    rows.append(_column_count(len(schemas.BRONZE.fields), 1))
    rows.append(_ordered_columns(schemas.BRONZE.names, 2))
    for entry in schemas.BRONZE.fields:
        name = entry.name
        if name in ("year", "month"):
            continue
        if name == "city":
            rule = _Rules.in_set(name, suites.CITIES)
            kind = "expect_column_values_to_be_in_set"
            rows.append(_map_row(kind, name, rule, "bronze", len(rows)))
        rows.append(_null_row(name, "bronze", len(rows)))
        rows.append(_exists(name, len(rows)))
        if name == "temperature":
            rule = _Rules.between(name, suites.TEMPERATURE_RANGE)
            kind = "expect_column_values_to_be_between"
            rows.append(_map_row(kind, name, rule, "bronze", len(rows)))
        if name in suites.BRONZE_REGEXES:
            rule = _Rules.regex(name, suites.BRONZE_REGEXES[name])
            kind = "expect_column_values_to_match_regex"
            rows.append(_map_row(kind, name, rule, "bronze", len(rows)))
        rows.append(_of_type(name, type_name(entry.dataType), len(rows)))
        if name in suites.STAMP_COLUMNS:
            rule = _Rules.strftime(name, suites.STAMP_FORMAT)
            kind = "expect_column_values_to_match_strftime_format"
            rows.append(_map_row(kind, name, rule, "bronze", len(rows)))
    return f"""{WITH_BRONZE}, described AS ({_described(f"{WITH_BRONZE} SELECT * FROM bronze")})
        SELECT {SUITE_OUTPUT} FROM ({' UNION ALL '.join(rows)})"""


def _suite_silver() -> str:
    rows = [_ordered_columns(schemas.SILVER.names, 0)]
    for columns in suites.SILVER_UNIQUE:
        rows.append(_compound_row(columns, "silver", len(rows)))
    for entry in schemas.SILVER.fields:
        name = entry.name
        rows.append(_null_row(name, "silver", len(rows)))
        rows.append(_exists(name, len(rows)))
        if name == "max_temperature":
            rule = _Rules.between(name, suites.TEMPERATURE_RANGE)
            kind = "expect_column_values_to_be_between"
            rows.append(_map_row(kind, name, rule, "silver", len(rows)))
        rows.append(_of_type(name, type_name(entry.dataType), len(rows)))
    return f"""{WITH_SILVER}, described AS ({_described(f"{WITH_SILVER} SELECT * FROM silver")})
        SELECT {SUITE_OUTPUT} FROM ({' UNION ALL '.join(rows)})"""


def _suite_stored_table() -> str:
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    stored = "SELECT * EXCLUDE (user_id), 'x' AS note FROM events"
    rows = [
        _column_count(6, 0),
        _ordered_columns(columns, 1),
        _exists("user_id", 2),
        _absent("expect_column_values_to_not_be_null", "user_id", 3),
        _absent("expect_column_values_to_be_of_type", "user_id", 4),
        _exists("value", 5),
        _of_type("value", "DoubleType", 6),
        _null_row("value", "events", 7),
    ]
    return f"""WITH described AS ({_described(stored)})
        SELECT {SUITE_OUTPUT} FROM ({' UNION ALL '.join(rows)})"""


def _listed(seq: int, value: str, where: str, rows: str, order: str = "") -> str:
    """The twenty smallest values that violate an expectation."""
    return f"""
SELECT CAST({seq} AS INTEGER) AS seq, CAST(place AS INTEGER) AS place, value FROM (
    SELECT {value} AS value, row_number() OVER (ORDER BY {order or value}) - 1 AS place
    FROM {rows} WHERE {where}) WHERE place < 20
"""


VALUE_RULE = _Rules.between("value", {"min_value": 0, "max_value": 50})
WITH_STAMPED = f"WITH stamped AS ({STAMPED})"


def _events_results() -> str:
    rows = [
        _verdict_row(
            "expect_table_row_count_to_be_between",
            None,
            "count(*) BETWEEN 1 AND 1000",
            "count(*)::VARCHAR",
            0,
            "FROM stamped",
        ),
        _compound_row(["user_id", "event_type"], "stamped", 1),
        _map_row(
            "expect_column_values_to_be_in_set",
            "event_type",
            _Rules.in_set("event_type", TYPES),
            "stamped",
            2,
        ),
        _null_row("stamp", "stamped", 3),
        _map_row(
            "expect_column_values_to_match_strftime_format",
            "stamp",
            _Rules.strftime("stamp", "%Y-%m-%d %H:%M:%S"),
            "stamped",
            4,
        ),
        _map_row("expect_column_values_to_be_between", "value", VALUE_RULE, "stamped", 5),
        _verdict_row("expect_column_values_to_be_of_type", "value", "true", "'DoubleType'", 6),
        _map_row(
            "expect_column_values_to_match_regex",
            "props",
            f"NOT regexp_matches(props, {TWO_DIGITS})",
            "stamped",
            7,
        ),
        _verdict_row(
            "expect_column_values_to_not_be_null", "absent", "false", NO_VALUE, 8, raised=True
        ),
    ]
    return f"{WITH_STAMPED}, results AS ({' UNION ALL '.join(rows)})"


WITH_RESULTS = _events_results()
COUNTS = "element_count, missing_count, unexpected_count"
PERCENTAGES = (
    "missing_percent, unexpected_percent, unexpected_percent_total, unexpected_percent_nonmissing"
)
STATISTICS = """
count(*) AS evaluated_expectations,
count(*) FILTER (WHERE success) AS successful_expectations,
count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
(count(*) FILTER (WHERE success))::DOUBLE * 100 / count(*) AS success_percent
"""


def _one(row: str, columns: str, prefix: str = "") -> str:
    return f"{prefix} SELECT {columns} FROM ({row})"


def _customer_countries(name: str) -> str:
    return f"""
SELECT c_custkey, CAST(c_custkey % 27 AS INTEGER) AS code, {name} AS country
FROM customer LEFT JOIN nation ON c_custkey % 27 = n_nationkey
"""


def _control(events_mark: str) -> str:
    return f"""
SELECT 'events' AS "TableName", ({events_mark}) AS "WatermarkValue"
UNION ALL SELECT 'orders', strftime(max(o_orderdate), {STAMP}) FROM orders
UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), {STAMP}) FROM lineitem
"""



def _runlog_events() -> str:
    """The lines of three runs of which the second was stopped, and finished by the third."""
    parts = ["ts <= TIMESTAMP '2024-01-10 00:20:00'",
             f"ts > TIMESTAMP '2024-01-10 00:20:00' AND ts <= TIMESTAMP '{CUT}'",
             f"ts > TIMESTAMP '{CUT}'"]

    def checks(part: int) -> str:
        """What fails in the suites: the row bound, temperatures and country codes."""
        upto = " OR ".join(f"({p})" for p in parts[: part + 1])
        between = "expect_column_values_to_be_between"
        hot = f"EXISTS (SELECT 1 FROM events WHERE ({upto}) AND NOT (value BETWEEN 0 AND 50))"
        odd = f"EXISTS (SELECT 1 FROM events WHERE ({upto}) AND user_id % 27 = 26)"
        many = f"(SELECT count(*) FROM events WHERE {upto}) > 1000"
        return f"""
            SELECT 'Bronze' AS layer, array_to_string(list_filter([
                CASE WHEN {many} THEN 'expect_table_row_count_to_be_between' END,
                CASE WHEN {hot} THEN '{between}' END,
                CASE WHEN {odd} THEN 'expect_column_values_to_match_regex' END
                ], lambda c: c IS NOT NULL), ', ') AS checks
            WHERE {many} OR {hot} OR {odd}
            UNION ALL SELECT 'Silver', '{between}' WHERE {hot}
        """

    def lines(part: int) -> str:
        upto = " OR ".join(f"({p})" for p in parts[: part + 1])
        return f"""
            SELECT 'INFO', 'slice of a run: ' || count(*) || ' rows stored, 0 rejected, 0 late'
            FROM events WHERE {parts[part]}
            UNION ALL SELECT 'INFO', 'silver refreshed up to '
                || strftime(date_trunc('second', max(ts)), {STAMP}) FROM events WHERE {upto}
            UNION ALL SELECT 'ERROR', 'checks of ' || layer || ' failed: ' || checks
            FROM ({checks(part)})
        """

    stopped = "SELECT 'ERROR', 'run stopped by InterruptedError: stopped before the mark'"
    body = " UNION ALL ".join([lines(0), lines(1), stopped, lines(1), lines(2)])
    return f"SELECT * FROM ({body}) logged(level, message)"


ORACLES: dict[str, str] = {
    "json_extract": INPUTS,
    "typed_batch": """
        SELECT event_type, event_id, value, user_id, CAST(NULL AS VARCHAR) AS note FROM events
    """,
    "epoch_to_string": f"""
        SELECT event_id, strftime(date_trunc('second', ts), {STAMP}) AS ts_text FROM events
    """,
    "utc_offset_label": f"""
        SELECT event_id, {OFFSET} AS offset_seconds, {_offset_label(OFFSET)} AS label FROM events
    """,
    "parse_event_time": f"""
        SELECT event_id, try_strptime(
            CASE WHEN event_type = 'error' THEN 'not a time'
                 ELSE strftime(date_trunc('second', ts), {STAMP}) END, {STAMP}) AS event_time
        FROM events
    """,
    "rename_drop": """
        SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus,
               o_totalprice AS total, o_orderdate, o_totalprice / 1000 AS price_thousands
        FROM orders
    """,
    "partition_columns": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders
    """,
    "dictionary_lookup": _customer_countries("coalesce(n_name, 'Unknown')"),
    "bronze_rows": f"{WITH_INPUTS} {BRONZE}",
    "watermark_lookup": f"""
        SELECT strftime(max(l_shipdate), {STAMP}) AS "WatermarkValue" FROM lineitem
    """,
    "incremental_filter": f"SELECT * FROM events WHERE ts > TIMESTAMP '{CUT}'",
    "initial_load": "SELECT * FROM events",
    "watermark_advance": _control(
        f"""SELECT coalesce(strftime(date_trunc('second', max(ts)), {STAMP}), '{CUT}')
            FROM events WHERE ts > TIMESTAMP '{CUT}'"""
    ),
    "late_rows": f"""
        SELECT event_type, count(*) AS late_count FROM events
        WHERE ts <= TIMESTAMP '{CUT}' GROUP BY event_type
    """,
    "entity_increment": f"""
        SELECT e.* FROM events e LEFT JOIN (
            SELECT event_type, max(ts) AS mark FROM events
            WHERE ts <= TIMESTAMP '{CUT}' GROUP BY event_type) m USING (event_type)
        WHERE mark IS NULL OR ts > mark
    """,
    "partitioned_append": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               count(*) AS rows,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM orders GROUP BY ALL
    """,
    "hourly_aggregate": _hourly("avg(value)"),
    "hourly_rounded": _hourly(_half_up("avg(value)")),
    "hourly_exact": _hourly(_half_up(_exact_mean("value"))),
    "silver_hourly": f"{WITH_BRONZE} {SILVER}",
    "silver_upsert": f"""
        WITH target AS ({_hourly(_exact_mean("value"), where="ts < TIMESTAMP '2024-01-21'")}),
        changed AS (SELECT * REPLACE (value + 1 AS value) FROM events
                    WHERE ts >= TIMESTAMP '{CUT}'),
        source AS (SELECT *, true AS in_source FROM ({_hourly(_exact_mean("value"), "changed")}))
        SELECT coalesce(t.event_type, s.event_type) AS event_type,
               coalesce(t.hour_start, s.hour_start) AS hour_start,
               coalesce(t.hour_end, s.hour_end) AS hour_end,
               CASE WHEN in_source THEN s.avg_temperature ELSE t.avg_temperature END
                   AS avg_temperature,
               CASE WHEN in_source THEN s.max_temperature ELSE t.max_temperature END
                   AS max_temperature,
               CASE WHEN in_source THEN s.record_count ELSE t.record_count END AS record_count
        FROM target t FULL OUTER JOIN source s
          ON t.event_type = s.event_type AND t.hour_start = s.hour_start
    """,
    "silver_sorted": f"""
        SELECT event_type AS city, * EXCLUDE (event_type)
        FROM ({_hourly(_exact_mean("value"))})
        ORDER BY city ASC, hour_start DESC LIMIT 20
    """,
    "incremental_refresh": _hourly(_exact_mean("value")),
    "expect_row_count": """
        SELECT 'expect_table_row_count_to_be_between' AS expectation_type,
               count(*) BETWEEN 1 AND 1000 AS success, count(*)::VARCHAR AS observed_value
        FROM events
    """,
    "expect_column_count": """
        SELECT 'expect_table_column_count_to_equal' AS expectation_type,
               count(*) = 6 AS success, count(*)::VARCHAR AS observed_value
        FROM (DESCRIBE events)
    """,
    "expect_columns_ordered": """
        SELECT 'expect_table_columns_to_match_ordered_list' AS expectation_type,
               string_agg(column_name, ',') = 'event_id,ts,user_id,event_type,value,props'
                   AS success,
               '[' || string_agg('"' || column_name || '"', ', ') || ']' AS observed_value
        FROM (DESCRIBE events)
    """,
    "expect_in_set": _one(
        _map_row(
            "expect_column_values_to_be_in_set",
            "event_type",
            _Rules.in_set("event_type", TYPES),
            "events",
            0,
        ),
        f"expectation_type, success, {COUNTS}, {PERCENTAGES}",
    ),
    "expect_not_null": _one(
        _null_row("country", "found", 0),
        f"expectation_type, success, {COUNTS}, unexpected_percent",
        f"WITH found AS ({_customer_countries('n_name')})",
    ),
    "expect_column_exists": """
        SELECT 'expect_column_to_exist' AS expectation_type, wanted AS "column",
               wanted IN (SELECT column_name FROM (DESCRIBE events)) AS success
        FROM (VALUES ('props'), ('absent')) w(wanted)
    """,
    "expect_between": _one(
        _map_row("expect_column_values_to_be_between", "value", VALUE_RULE, "events", 0),
        f"expectation_type, success, {COUNTS}, {PERCENTAGES}",
    ),
    "expect_regex": _one(
        _map_row(
            "expect_column_values_to_match_regex",
            "props",
            f"NOT regexp_matches(props, {TWO_DIGITS})",
            "events",
            0,
        ),
        f"expectation_type, success, {COUNTS}, {PERCENTAGES}",
    ),
    "expect_type": """
        SELECT 'expect_column_values_to_be_of_type' AS expectation_type,
               column_name AS "column", observed_value, observed_value = wanted AS success
        FROM (SELECT column_name,
                     CASE column_type WHEN 'TIMESTAMP' THEN 'TimestampNTZType'
                                      WHEN 'DOUBLE' THEN 'DoubleType' END AS observed_value,
                     CASE column_name WHEN 'ts' THEN 'TimestampNTZType'
                                      ELSE 'LongType' END AS wanted
              FROM (DESCRIBE events) WHERE column_name IN ('ts', 'value'))
    """,
    "expect_strftime": _one(
        _map_row(
            "expect_column_values_to_match_strftime_format",
            "stamp",
            _Rules.strftime("stamp", "%Y-%m-%d %H:%M:%S"),
            "stamped",
            0,
        ),
        f"expectation_type, success, {COUNTS}, {PERCENTAGES}",
        WITH_STAMPED,
    ),
    "expect_compound_unique": _one(
        _compound_row(["user_id", "event_type"], "events", 0)
        + " UNION ALL "
        + _compound_row(["event_id"], "events", 1),
        f"seq, expectation_type, success, {COUNTS}",
    ),
    "suite_bronze": _suite_bronze(),
    "suite_silver": _suite_silver(),
    "validation_results": f"{WITH_RESULTS} SELECT * FROM results",
    "validation_statistics": f"{WITH_RESULTS} SELECT {STATISTICS} FROM results",
    "validation_failures": f"""{WITH_RESULTS}
        SELECT seq, expectation_type, "column" FROM results WHERE NOT success
    """,
    "validation_offenders": f"""{WITH_STAMPED} {" UNION ALL ".join([
        _listed(2, "event_type", _Rules.in_set("event_type", TYPES), "stamped"),
        _listed(3, "'null'", "stamp IS NULL", "stamped"),
        _listed(4, "stamp", f"stamp IS NOT NULL AND {_Rules.strftime('stamp', '%Y-%m-%d %H:%M:%S')}",
                "stamped"),
        _listed(5, "value::VARCHAR", VALUE_RULE, "stamped", "value"),
        _listed(7, "props", f"NOT regexp_matches(props, {TWO_DIGITS})", "stamped"),
    ])}""",
    "validation_cumulative": f"""{WITH_BRONZE}
        SELECT 'expect_column_values_to_be_between' AS expectation_type,
            'temperature' AS "column", (SELECT count(*) FROM bronze) AS element_count,
            0::BIGINT AS missing_count,
            (SELECT count(*) FROM bronze WHERE NOT (temperature BETWEEN 0 AND 50))
                AS unexpected_count, place, value
        FROM ({_listed(0, "temperature::VARCHAR", "NOT (temperature BETWEEN 0 AND 50)",
                       "bronze", "temperature")})
        UNION ALL SELECT 'expect_column_values_to_match_regex', 'countrycode',
            (SELECT count(*) FROM bronze), 0::BIGINT,
            (SELECT count(*) FROM bronze
                WHERE {_Rules.regex("countrycode", suites.BRONZE_REGEXES["countrycode"])}),
            place, value
        FROM ({_listed(0, "countrycode",
                       _Rules.regex("countrycode", suites.BRONZE_REGEXES["countrycode"]),
                       "bronze")})
    """,
    "validation_report": f"""{WITH_RESULTS}
        SELECT 'run-1' AS run_id, 'Events' AS layer, 'events' AS suite_name, {STATISTICS}
        FROM results
    """,
    "validation_document": f"""{WITH_RESULTS}
        SELECT seq, expectation_type, success, {COUNTS} FROM results
    """,
    "runlog_parse": LOG,
    "runlog_tail": f"""
        SELECT seq, level, message FROM ({LOG})
        WHERE log_date = DATE '2024-01-15' AND level = 'ERROR'
        ORDER BY log_time DESC, seq DESC LIMIT 10
    """,
    "runlog_days": "SELECT DISTINCT CAST(ts AS DATE) AS log_date FROM events",
    "end_to_end_refresh": f"{WITH_BRONZE} {SILVER}",
    "interrupted_refresh": f"{WITH_SILVER} SELECT *, record_count AS bronze_rows FROM silver",
    "runlog_events": _runlog_events(),
    "quarantine": """
        SELECT CASE event_type WHEN 'error' THEN 'Sydney' END AS city,
               'no document, ' || event_id AS payload,
               CASE event_type WHEN 'error' THEN 'no event time' ELSE 'no city' END AS reason
        FROM events, range(2) WHERE event_type IN ('error', 'view')
    """,
    "streaming_refresh": f"{WITH_BRONZE} {SILVER}",
    "streaming_late": f"""{WITH_INPUTS}, bronze AS (
        SELECT b.* FROM ({BRONZE}) b, range(2) r
        WHERE event_time >= (SELECT date_trunc('second', min(ts)) FROM events
                WHERE ts > TIMESTAMP '2024-01-10 00:20:00')
            AND (r.range = 0 OR event_time > (SELECT date_trunc('second', max(ts)) FROM events
                WHERE ts <= TIMESTAMP '{CUT}'))
        ) {SILVER}
    """,
    "suite_stored_table": _suite_stored_table(),
}
