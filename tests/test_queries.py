"""Every registered query with an oracle gives the oracle's rows on the smallest supplied tables."""

import datetime
import decimal
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if type(value) is datetime.date:
        return datetime.datetime(value.year, value.month, value.day)
    return value


def table(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(row[p]) for p in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    result = oracle.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_flagship_query_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_operator_of_the_inventory_is_registered():
    groups = {"a": 20, "b": 17, "c": 10, "d": 38, "e": 5, "f": 4, "g": 3, "h": 15, "i": 15, "j": 9, "k": 6, "l": 26, "m": 9, "n": 7}
    found = {m.group() for name in QUERIES if (m := re.match(r"[a-n]\d\d", name))}
    assert {f"{g}{i:02d}" for g, n in groups.items() for i in range(1, n + 1)} <= found


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
