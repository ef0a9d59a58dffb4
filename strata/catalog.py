"""Namespaces, typed tables, atomic replacement and read-back."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.config import LayerConfig
from strata.session import session_conf

VERSION_PROPERTY = "strata.version"
# Property of a view that shows a table's rows without its technical columns: the table's name.
STORED_IN = "strata.stored_in"


def create_namespaces(spark: SparkSession, config: LayerConfig) -> None:
    for database, location in config.databases.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{location}'")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType | str,
    partitioned_by: tuple[str, ...] = (),
) -> None:
    """Create a typed table if absent. One that exists with other columns is refused: a Parquet
    append would write to it without a check."""
    declared = [(f.name, f.dataType.simpleString()) for f in as_schema(schema)]
    columns = ", ".join(f"{quoted(column)} {kind}" for column, kind in declared)
    partitions = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitions}")
    found = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema]
    if found != declared:
        raise ValueError(f"{name} exists with the columns {found}, not {declared}")


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Select and cast to a declared schema."""
    return df.select(*[F.col(quoted(f.name)).cast(f.dataType) for f in as_schema(schema)])


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions present in ``df``, so that a retried write adds nothing.

    A few open writers per task spare the sort by partition value that Spark adds otherwise.
    """
    settings = {
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    }
    with session_conf(df.sparkSession, settings):
        df.write.mode("overwrite").insertInto(table)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Table or view properties; empty if the relation does not exist."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def publish_view(
    spark: SparkSession, name: str, query: str, marks: dict[str, str] | None = None
) -> None:
    """Point ``name`` at ``query``. One catalog operation: readers see the old or the new."""
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in (marks or {}).items())
    tail = f"TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} {tail} AS {query}")


def stream_of(spark: SparkSession, name: str, files_per_batch: int) -> DataFrame:
    """A table as a stream of what is appended; for a view over one table, that table."""
    stored = properties(spark, name).get(STORED_IN, name)
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).table(stored)


def replace_table(spark: SparkSession, name: str, df: DataFrame, keep: int = 1) -> None:
    """Create or replace ``name`` with the rows and the schema of ``df``.

    The rows go to a new table, then the published name switches over. The ``keep`` versions before
    it stay for readers that have already planned on them; older ones and left-overs of failed runs
    go. A plain table that has the name becomes such a version; between its renaming and the
    publication, a moment, the name is missing.
    """
    database, _, table = name.rpartition(".")
    version = f"{table}__{uuid4().hex}"
    df.write.format("parquet").saveAsTable(f"{database}.{version}")
    before = properties(spark, name)
    previous = [v for v in before.get(VERSION_PROPERTY, "").split(",") if v]
    if spark.catalog.tableExists(name) and not previous:
        previous = [f"{table}__{uuid4().hex}"]
        spark.sql(f"ALTER TABLE {name} RENAME TO {database}.{previous[0]}")
    kept = [version, *previous][: keep + 1]
    publish_view(
        spark, name, f"SELECT * FROM {database}.{version}", {VERSION_PROPERTY: ",".join(kept)}
    )
    versions = re.compile(re.escape(table) + "__[0-9a-f]{32}")
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__*'").collect():
        if versions.fullmatch(row["tableName"]) and row["tableName"] not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")


def read_back(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def row_count(df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT COUNT(*)``: the distinct applies to the one-row result, not to the rows."""
    return df.agg(F.count("*").alias("row_count")).distinct()
