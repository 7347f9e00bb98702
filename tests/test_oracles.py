"""Every registered query with SQL gives the rows that DuckDB gives."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


# Kinds of types as either side calls them; sums of whole numbers are wider in DuckDB.
KINDS = {
    "whole": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"),
    "number": ("float", "double"), "text": ("string", "varchar"), "flag": ("boolean",), "day": ("date",),
    "moment": ("timestamp", "timestamp_ntz", "timestamp with time zone"),
}


def kind_of(name):
    name = str(name).lower()
    if name.startswith("decimal"):
        return "whole" if name.endswith(",0)") else "number"
    return next((kind for kind, names in KINDS.items() if name in names), name.split("<")[0].split("[")[0])


def typed(value):
    """A value by which rows can be sorted and compared, its type included."""
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (type(value).__name__, str(value))


def comparable(rows, columns, order):
    places = [columns.index(name) for name in order]
    return sorted(tuple(typed(row[place]) for place in places) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    made = entry_points.queries()[name](spark, SMALL)
    expected = duck.sql(entry_points.oracle_sql()[name])
    order = sorted(made.columns)
    assert order == sorted(expected.columns)
    mine, theirs = dict(made.dtypes), dict(zip(expected.columns, expected.types, strict=True))
    assert {n: kind_of(k) for n, k in mine.items()} == {n: kind_of(k) for n, k in theirs.items()}
    rows = [tuple(row) for row in made.collect()]
    assert comparable(rows, made.columns, order) == comparable(
        expected.fetchall(), expected.columns, order
    )


def test_every_query_is_callable_and_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    top = entry_points.entry(spark).collect()
    assert len(top) == 20
    assert top[0]["tie_strength"] >= top[-1]["tie_strength"]
