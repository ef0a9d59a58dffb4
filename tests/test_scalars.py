from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.scalars import (
    clean_price,
    drop_technical,
    total_price,
    with_created_at,
    with_version_columns,
)


@pytest.mark.parametrize(
    "text, value",
    [
        ("$12.00", "12.00"),
        ("12.345", "12.35"),
        ("99.994", "99.99"),
        ("100.00", None),
        ("", None),
        ("$1$2.50", "12.50"),
        ("abc", None),
        (" 9.5 ", "9.50"),
        (None, None),
    ],
)
def test_clean_price(spark, text, value):
    df = spark.createDataFrame([(text,)], "price string").select(clean_price(F.col("price")))
    assert df.schema.fields[0].dataType.simpleString() == "decimal(4,2)"
    assert df.first()[0] == (value and Decimal(value))


def test_strict_price_raises(spark):
    df = spark.createDataFrame([("abc",)], "price string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        df.select(clean_price(F.col("price"), strict=True)).collect()


def test_total_price_type_and_null(spark):
    df = spark.createDataFrame(
        [(Decimal("9.99"), 3), (None, 3), (Decimal("1.00"), None)], "p decimal(4,2), q long"
    ).select(total_price(F.col("p"), F.col("q")).alias("t"))
    assert df.schema["t"].dataType.simpleString() == "decimal(25,2)"
    assert [r.t for r in df.collect()] == [Decimal("29.97"), None, None]


def test_version_columns(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 3, 4, 23, 59), "x", "f")],
        "k int, created_at timestamp, _rescued_data string, source_file string",
    )
    out = with_version_columns(df)
    assert out.columns == ["k", "start_date", "end_date", "status"]
    assert out.schema["end_date"].dataType.simpleString() == "date"
    assert out.first()[:] == (1, date(2024, 3, 4), None, "a")


def test_drop_technical_ignores_absent_columns(spark):
    assert drop_technical(spark.range(1)).columns == ["id"]


def test_created_at_is_one_instant(spark):
    assert with_created_at(spark.range(1000, numPartitions=8)).select("created_at").distinct().count() == 1
