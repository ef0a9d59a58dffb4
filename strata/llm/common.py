"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import session
from strata.session import map_batches

__all__ = ["bucketed", "crc32_of", "draw", "map_batches", "remembered", "shared_folder", "table", "written"]

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return f"{session.shared_folder(spark)}/llm-{uuid4().hex}"


#: What a Python worker remembers from task to task, by operator.
REMEMBERED: dict[str, object] = {}


def remembered(operator: str, make: Callable[[], T]) -> T:
    """What this worker remembers for an operator; it then forgets what it did for others."""
    if operator not in REMEMBERED:
        REMEMBERED.clear()
        REMEMBERED[operator] = make()
    return REMEMBERED[operator]


#: Rows that pass to a Python worker at a time where this module runs the job: texts are long.
ROWS_AT_A_TIME = 1000


def few_rows(spark: SparkSession) -> dict[str, str]:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = int(spark.conf.get(key))
    return {key: str(ROWS_AT_A_TIME if own <= 0 else min(own, ROWS_AT_A_TIME))}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    with session.session_conf(spark, few_rows(spark)):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """`written`, in buckets by `key`: groups and joins by it need no shuffle of these rows. The
    catalog knows the table only until it is read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    known = f"llm_{name}_{uuid4().hex}"
    with session.session_conf(spark, few_rows(spark)):
        df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(known, format="parquet")
    try:
        rows = spark.table(known)
        rows.schema  # noqa: B018 (resolves the table)
        return rows
    finally:
        # An external table: its files stay.
        spark.sql(f"DROP TABLE {known}")


def crc32_of(column: str) -> Column:
    return F.crc32(F.col(column).cast("string"))


def draw(rows: DataFrame, key: str, classes: list[str], most: int) -> DataFrame:
    """At most `most` rows of each combination of `classes`, by a hash of the key, with their `place`.

    Only about four times as many are ranked, whatever the share of a class: the classes are
    counted first, a row for each. Adds `place` from 1; the keys must not be NULL.
    """
    counts = rows.groupBy(*classes).count().collect()
    slots = 1 << 30
    wanted = F.lit(False)
    for row in counts:
        own = F.lit(True)
        for c in classes:
            own = own & (F.col(c) == F.lit(row[c]))
        share = min(slots, -(-4 * most * slots // row["count"]))
        wanted = F.when(own, F.pmod(F.xxhash64(key), F.lit(slots)) < share).otherwise(wanted)
    order = Window.partitionBy(*classes).orderBy(F.xxhash64(F.col(key), F.lit(1)), key)
    return rows.where(wanted).withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
