"""Column expressions: price cleaning, audit columns, version columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The status codes and the audit columns of the data model.
ACTIVE = "a"
INACTIVE = "i"
RESCUED = "_rescued_data"
CREATED_AT = "created_at"
SOURCE_FILE = "source_file"
START_DATE = "start_date"
END_DATE = "end_date"
STATUS = "status"

BATCH_ID = "_batch_id"
BUCKET = "_bucket"
TECHNICAL = (RESCUED, CREATED_AT, SOURCE_FILE, BATCH_ID)


def clean_price(price: Column, strict: bool = False) -> Column:
    """Drop every ``$`` and read a DECIMAL(4,2).

    Text that does not fit gives NULL; with ``strict`` it fails the query under ANSI mode.
    """
    digits = F.replace(price, F.lit("$"), F.lit(""))
    return digits.cast("decimal(4,2)") if strict else digits.try_cast("decimal(4,2)")


def total_price(price: Column, quantity: Column) -> Column:
    return price * quantity


def with_created_at(df: DataFrame) -> DataFrame:
    return df.withColumn(CREATED_AT, F.current_timestamp())


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


def with_version_columns(df: DataFrame) -> DataFrame:
    """Open a version on the ingestion day and drop the audit columns."""
    return drop_technical(
        df.withColumns(
            {
                START_DATE: F.to_date(CREATED_AT),
                END_DATE: F.lit(None).cast("date"),
                STATUS: F.lit(ACTIVE),
            }
        )
    )
