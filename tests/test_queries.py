"""Every registered query against its SQL counterpart, on whole tables."""

import os
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from strata import workload
from strata.session import session_conf
from strata.workload import QUERIES, drop_scratch, scratch

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


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == contract.ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = tables.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert bag(result.columns, result.collect()) == bag(expected.columns, expected.fetchall())
    drop_scratch(spark)


def test_scratch_needs_a_shared_folder():
    def session(settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    with pytest.raises(ValueError, match="all executors share"):
        scratch(session({"spark.master": "yarn"}))
    local = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "/w/"}
    assert scratch(session(local)).startswith("/w/strata-")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark), scratch(spark)
    assert first.startswith(f"{shared}/") and second.startswith(f"{shared}/") and first != second


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()


def test_sample_of_ten_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    orders = spark.range(4400).select(
        F.col("id").alias("o_orderkey"), F.lit("2020-01-01").cast("date").alias("o_orderdate")
    )
    orders.repartition(16).write.parquet(str(tmp_path / "orders.parquet"))
    tasks, write = [], workload.write_json

    def counted(rows, path):
        tasks.append(rows.select(F.spark_partition_id()).distinct().count())
        write(rows, path)

    monkeypatch.setattr(workload, "write_json", counted)
    with session_conf(spark, {"spark.sql.files.openCostInBytes": str(2**30)}):
        found = workload.sample_of_ten(spark, str(tmp_path)).collect()
    assert tasks == [16, 16]
    assert {(r.order_id, r.late) for r in found} == {(i, "1" if i % 11 == 10 else None) for i in range(4400)}
    drop_scratch(spark)
