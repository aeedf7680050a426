"""SQL for the queries of :mod:`jobs`."""

from __future__ import annotations

from tidemark.operators import expectations as ex
from tidemark.plans.jobs import FAULTY, KEYS, LACKING, SCHEMA_CHECKS
from tidemark.plans.observations import CITY_OF
from tidemark.plans.oracles import (
    BRONZE,
    LOG,
    SILVER,
    WITH_BRONZE,
    WITH_SILVER,
    _exact_mean,
    _half_up,
    _hourly,
)
from tidemark.plans.queries import CUT
from tidemark.plans.suites import bronze_suite, silver_suite

BESIDE_BRONZE = f"{WITH_SILVER} SELECT *, record_count AS bronze_rows FROM silver"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _true_mean(value: str) -> str:
    """Average from the exact sum of doubles: each as a whole number of 2**-60, which all given
    values are, and the sum read from its digits."""
    unit = 1 << 60
    units = f"sum(CAST(CAST({value} AS DOUBLE) * {unit}::DOUBLE AS HUGEINT))"
    return f"CAST(CAST({units} AS VARCHAR) AS DOUBLE) / {unit}::DOUBLE / count({value})"


def _faults() -> str:
    cases = "".join(
        f"""
        UNION ALL SELECT {_quoted(CITY_OF[kind])}, '{{"main":' || {_quoted(main)} || ',"dt":'
            || CAST(floor(epoch(ts)) AS BIGINT) || ',"wind":' || {_quoted(wind)}
            || ',"weather":[],"sys":{{}},"timezone":null}}', {_quoted(reason)}
        FROM events WHERE event_type = '{kind}'"""
        for kind, (main, wind, reason) in FAULTY.items()
    )
    return cases.replace("UNION ALL ", "", 1).replace(
        "SELECT 'New York',", "SELECT 'New York' AS city,", 1
    )


def _stored_files() -> str:
    """Which checks hold: all but those of the lists of columns and of the column that lacks."""
    rows = []
    for scope in ("table", "increment"):
        for layer, suite in (("Bronze", bronze_suite()), ("Silver", silver_suite())):
            lacking = LACKING[layer] if (scope, layer) != ("increment", "Silver") else None
            shown = "Bronze_slice" if (scope, layer) == ("increment", "Bronze") else layer
            for seq, check in enumerate(suite.ordered()):
                kind, column = check.expectation_type, check.column
                if kind not in SCHEMA_CHECKS and column not in LACKING.values():
                    continue
                success = not lacking or not (
                    column == lacking or kind in (ex.COLUMN_COUNT, ex.ORDERED_COLUMNS)
                )
                held = "true" if success else "false"
                if kind == ex.BETWEEN and success:
                    held = f"(SELECT bool_and(value BETWEEN 0 AND 50) FROM events WHERE ts > TIMESTAMP '{CUT}')"
                name = "CAST(NULL AS VARCHAR)" if column is None else _quoted(column)
                rows.append(
                    f"SELECT {_quoted(scope)} AS scope, {_quoted(shown)} AS layer, "
                    f"{seq}::INTEGER AS seq, {_quoted(kind)} AS expectation_type, "
                    f'{name} AS "column", {held} AS success'
                )
    return " UNION ALL ".join(rows)


def _unique() -> str:
    parts = []
    for seq, key in enumerate(KEYS):
        columns = ", ".join(f'"{name}"' for name in key)
        text = " || ', ' || ".join(
            f"""'"{name}": ' || """
            + (f'"{name}"' if name == "humidity" else f"""'"' || "{name}" || '"'""")
            for name in key
        )
        order = text.replace(": ", ":").replace("', '", "','")
        parts.append(
            f"""
        SELECT {seq}::INTEGER AS seq, wrong = 0 AS success, elements AS element_count,
            0::BIGINT AS missing_count, coalesce(wrong, 0) AS unexpected_count, place, value
        FROM (SELECT (SELECT count(*) FROM bronze) AS elements, CAST(coalesce((
                SELECT sum(n) FROM (SELECT count(*) AS n FROM bronze GROUP BY {columns})
                WHERE n > 1), 0) AS BIGINT) AS wrong)
        LEFT JOIN (
            SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS place,
                '{{' || {text} || '}}' AS value
            FROM (SELECT {columns} FROM bronze GROUP BY {columns} HAVING count(*) > 1)
        ) ON place < 20"""
        )
    return f"{WITH_BRONZE} {' UNION ALL '.join(parts)}"


def _versions() -> str:
    columns = """city, hour_start, hour_end, avg_temperature, avg_humidity, avg_windspeed,
        max_temperature, record_count"""

    def seen(reader: str, table: str) -> str:
        return f"SELECT {columns}, '{reader}' AS reader FROM {table}"

    old = f"""old_inputs AS (
        SELECT * FROM inputs WHERE "timestamp" <= '{CUT}'),
        old_bronze AS ({BRONZE.replace("FROM inputs", "FROM old_inputs")}),
        old AS ({SILVER.replace("FROM bronze", "FROM old_bronze")})"""
    return f"""{WITH_SILVER}, {old}
        {seen("began before", "old")} UNION ALL {seen("asked", "old")}
        UNION ALL {seen("after", "silver")}"""


TRUE_SILVER = SILVER
for _measure in ("temperature", "humidity", "windspeed"):
    TRUE_SILVER = TRUE_SILVER.replace(_exact_mean(_measure), _true_mean(_measure))

ORACLES: dict[str, str] = {
    "streaming_two_checkpoints": BESIDE_BRONZE,
    "stateful_hourly": f"""{WITH_SILVER} SELECT * FROM silver
        WHERE hour_end <= (SELECT max(event_time) - INTERVAL 10 DAY FROM bronze)""",
    "entity_refresh": BESIDE_BRONZE,
    "quarantine_faults": f"""SELECT * FROM ({_faults()}) rejected(city, payload, reason)""",
    "landed_once": BESIDE_BRONZE,
    "catalog_refresh": f"{WITH_BRONZE} {SILVER}",
    "silver_versions": _versions(),
    "suite_stored_files": _stored_files(),
    "unique_cumulative": _unique(),
    "hourly_reproducible": _hourly(_half_up(_true_mean("value"))),
    "silver_reproducible": WITH_BRONZE + TRUE_SILVER,
    "runlog_files": f"""
        SELECT strftime(log_date, '%Y-%m-%d') AS day, line, level, message FROM (
            SELECT *, row_number() OVER (PARTITION BY log_date ORDER BY log_time, seq) AS line
            FROM ({LOG}))
        WHERE level = 'ERROR' ORDER BY log_date DESC, line DESC LIMIT 500
    """,
}
