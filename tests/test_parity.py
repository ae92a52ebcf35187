"""Every reference-shaped query runs, and agrees with DuckDB where it has oracle SQL."""

import math

import duckdb
import pytest

from tidemark.plans import catalog, domain, joins, reads, registry, views  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(round(value, 6) if isinstance(value, float) else value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = catalog.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(tuple(normal(row[c]) for c in columns) for row in frame.collect())
    if name not in catalog.ORACLES:
        assert got
        return
    relation = duck.sql(catalog.ORACLES[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted(tuple(normal(row[i]) for i in at) for row in relation.fetchall())
