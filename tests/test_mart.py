from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators.mart import MartSpec, build_mart
from strata.plans.orders import HEADERS_SCHEMA, LINES_SCHEMA, PRODUCTS_SCHEMA, TYPES_SCHEMA
from strata.session import join_settings, session_conf

DAY = date(2024, 1, 1)


def product(key, type_key, price, status="a"):
    return (key, type_key, "M", price and Decimal(price), DAY, None, status)


def kind(key, name, status="a"):
    return (key, name, "cat", "x", DAY, None, status)


def mart(spark, lines, headers, products, types):
    return build_mart(
        spark.createDataFrame(lines, LINES_SCHEMA),
        spark.createDataFrame(headers, HEADERS_SCHEMA),
        spark.createDataFrame(products, PRODUCTS_SCHEMA),
        spark.createDataFrame(types, TYPES_SCHEMA),
    )


def test_columns_and_types(spark):
    assert mart(spark, [], [], [], []).dtypes == [
        ("line_id", "bigint"),
        ("order_id", "bigint"),
        ("order_date", "date"),
        ("order_time", "string"),
        ("product_name", "string"),
        ("product_category", "string"),
        ("size", "string"),
        ("quantity", "bigint"),
        ("total_price", "decimal(25,2)"),
    ]


def test_missing_partners(spark):
    lines = [(1, 10, "p", 2), (2, 99, "p", 2), (3, None, "p", 2), (4, 10, "none", 1), (5, 10, "q", 1), (6, 10, None, 1)]
    out = mart(
        spark, lines, [(10, DAY, "12:00:00")],
        [product("p", "t", "1.50"), product("q", "none", "1.00"), product(None, "t", "1.00")],
        [kind("t", "name"), kind(None, "name")],
    )
    assert {(r.line_id, r.order_date, r.total_price) for r in out.collect()} == {
        (1, DAY, Decimal("3.00")),
        (2, None, Decimal("3.00")),
        (3, None, Decimal("3.00")),
    }


def test_versions_multiply(spark):
    out = mart(
        spark, [(1, 10, "p", 2)], [(10, DAY, "12:00:00")],
        [product("p", "t", "1.50", "i"), product("p", "t", None)],
        [kind("t", "old", "i"), kind("t", "new")],
    )
    assert Counter((r.product_name, r.total_price) for r in out.collect()) == Counter(
        [("old", Decimal("3.00")), ("new", Decimal("3.00")), ("old", None), ("new", None)]
    )


def test_other_column_names(spark):
    spec = MartSpec(
        order_key="oid", product_key="pid", type_key="tid",
        columns=(("line", "lid", "line"), ("type", "label", "label")),
        price="cost", quantity="n", total="sum",
    )
    out = build_mart(
        spark.createDataFrame([(1, 2, 3, 4)], "lid int, oid int, pid int, n long"),
        spark.createDataFrame([(2,)], "oid int"),
        spark.createDataFrame([(3, 5, Decimal("2.00"))], "pid int, tid int, cost decimal(4,2)"),
        spark.createDataFrame([(5, "x")], "tid int, label string"),
        spec,
    )
    assert [r.asDict() for r in out.collect()] == [{"line": 1, "label": "x", "sum": Decimal("8.00")}]


def test_lines_are_shuffled_by_order_and_product_only(spark, tmp_path, capsys):
    """Also if nothing is broadcast, and all lines have one type."""
    lines = [(i, i % 7, str(i % 5), 1) for i in range(200)]
    frames = {
        "lines": spark.createDataFrame(lines, "line_id long, order_id long, product_id string, quantity long"),
        "headers": spark.createDataFrame([(i, DAY, "12:00:00") for i in range(7)], "order_id long, date date, time string"),
        "products": spark.createDataFrame([product(str(i), "t", "1.00") for i in range(5)], PRODUCTS_SCHEMA),
        "types": spark.createDataFrame([kind("t", "a", "i"), kind("t", "b")], TYPES_SCHEMA),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = build_mart(*[spark.read.parquet(str(tmp_path / name)) for name in frames])
        assert out.count() == 400
        out.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert sorted(keys) == ["order_id", "order_id", "product_id", "product_id", "product_type_id", "product_type_id"]


@pytest.mark.parametrize("join", ["SortMergeJoin", "ShuffledHashJoin"])
@pytest.mark.parametrize("hot", [7, None])
def test_hot_keys_are_split(spark, tmp_path, capsys, hot, join):
    """A third of the lines share one order, or have none, and a third share one product: the
    joins split those partitions."""
    lines = spark.range(0, 300000, numPartitions=16).select(
        F.col("id").alias("line_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("long").alias("order_id"),
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 50).cast("string").alias("product_id"),
        F.lit(1).cast("long").alias("quantity"),
    )
    headers = spark.range(0, 300000, numPartitions=16).select(
        F.col("id").alias("order_id"), F.lit(DAY).alias("date"), F.lit("12:00:00").alias("time")
    )
    for name, df in (("lines", lines), ("headers", headers)):
        df.write.parquet(str(tmp_path / name))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    if join == "ShuffledHashJoin":
        settings = {**join_settings(spark), **settings}
    with session_conf(spark, settings):
        out = build_mart(
            spark.read.parquet(str(tmp_path / "lines")),
            spark.read.parquet(str(tmp_path / "headers")),
            spark.createDataFrame([product(str(i), "t", "1.00") for i in range(50)], PRODUCTS_SCHEMA),
            spark.createDataFrame([kind("t", "name")], TYPES_SCHEMA),
        )
        assert len(out.collect()) == 300000
        out.explain()
    plan = capsys.readouterr().out
    assert plan.count(f"{join}(skew=true)") >= 2
