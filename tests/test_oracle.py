"""Every registered query against its SQL on another engine."""

import math

import duckdb
import pytest

from tidemark.plans import job_oracles, jobs, oracles, queries

QUERIES = queries.QUERIES | jobs.QUERIES
ORACLES = oracles.ORACLES | job_oracles.ORACLES

TABLES = ("nation", "customer", "orders", "lineitem", "events")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda n: names[n])

    def text(value):
        missing = value is None or (isinstance(value, float) and math.isnan(value))
        return "" if missing else repr(value)

    return sorted(tuple(text(row[n]) for n in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    relation = oracle.sql(ORACLES[name])
    expected = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {n: TYPES[t] for n, t in result.dtypes} == expected
    rows = relation.fetchall()
    assert normal(result.collect(), result.columns) == normal(rows, relation.columns)
    assert rows
