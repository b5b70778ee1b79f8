"""Every registered query against its SQL on the smallest tables."""

import datetime

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value) if isinstance(value, (datetime.date, datetime.datetime)) else value


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, sql, name):
    result = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(result.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in result.collect()]
    statement = __spark_entry__.oracle_sql().get(name)
    if statement is None:
        assert got
        return
    answer = sql.execute(statement)
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    types = {d[0]: str(d[1]) for d in answer.description}
    assert {c: TYPES[result.schema[c].dataType.simpleString()] for c in columns} == {c: types[c] for c in columns}
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["date"] + [str(h) for h in range(24)]
