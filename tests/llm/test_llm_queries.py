"""The registered queries of the operators against their SQL, on whole tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from strata.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = tables.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert bag(result.columns, result.collect()) == bag(expected.columns, expected.fetchall())
