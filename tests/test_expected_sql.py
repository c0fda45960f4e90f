"""Every registered query against its SQL, on whole tables."""

import datetime
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from feeds import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sf_dir():
    """SF_DIR compares at another scale."""
    return os.environ.get("SF_DIR", SF_DIR)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _text(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, (str, bool)):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(pd.Timestamp(value))
    return f"{float(value):.6f}"


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, sf_dir, name):
    result = registry.queries()[name](spark, sf_dir)
    cursor = duck.execute(registry.oracle_sql()[name])
    expected = _table([c[0] for c in cursor.description], cursor.fetchall())
    assert _table(result.columns, result.collect()) == expected
    assert expected[1], "the comparison must not be empty"


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    """A row for each day of the smoke table on which a session began."""
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{registry.SMOKE_DIR}/events.parquet'")
    days = duck.execute(f"SELECT count(*) FROM ({registry.oracle_sql()['session_funnel_daily']})").fetchone()[0]
    assert registry.entry(spark).count() == days > 0
