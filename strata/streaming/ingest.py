"""Incremental ingest of growing file folders into bronze tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.catalog import STORED_IN, create_table, overwrite_partitions, publish_view, quoted
from strata.functions.scalars import BATCH_ID, CREATED_AT, RESCUED, SOURCE_FILE, with_created_at
from strata.session import session_conf
from strata.sources.csv_feed import read_any_header, too_wide, widest_row
from strata.sources.json_feed import parse_json_lines
from strata.sources.schema import FILE_LISTING, WIDEST_ROW, frozen_schema
from strata.streaming.drain import drain, stream_identity


@dataclass(frozen=True)
class FeedSpec:
    """A folder of CSV or JSON files and the bronze table it fills.

    ``sample`` is the number of files the schema is inferred from, all present ones if None;
    ``files_per_batch`` bounds those of one micro-batch, or ``bytes_per_batch``, where set, their
    bytes; the rest follow in the next batches of the same run.
    """

    file_format: str
    path: str
    table: str
    checkpoint: str
    name: str
    sample: int | None = None
    hints: str | None = None
    files_per_batch: int = 1000
    bytes_per_batch: str | None = None

    @property
    def schema_location(self) -> str:
        return f"{self.checkpoint}/inferred_schema"


def feed_schema(spark: SparkSession, feed: FeedSpec) -> StructType:
    return frozen_schema(
        spark, feed.file_format, feed.path, feed.schema_location, feed.sample, feed.hints
    )


def file_options(feed: FeedSpec) -> dict[str, object]:
    """Files of all subfolders count, but for those that begin with an underscore or a dot."""
    bound = {"maxFilesPerTrigger": feed.files_per_batch}
    if feed.bytes_per_batch is not None:
        bound = {"maxBytesPerTrigger": feed.bytes_per_batch}
    return {**bound, "recursiveFileLookup": True}


def ingest(spark: SparkSession, feed: FeedSpec) -> None:
    {"csv": ingest_csv, "json": ingest_json}[feed.file_format](spark, feed)


def ingest_json(spark: SparkSession, feed: FeedSpec) -> None:
    schema = feed_schema(spark, feed)
    create_table(spark, feed.table, bronze_schema(schema))
    lines = (
        spark.readStream.format("text")
        .options(**file_options(feed))
        .load(feed.path)
        .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    rows = bronze_rows(parse_json_lines(lines, schema), schema)
    drain(rows, feed.name, feed.checkpoint, feed.table)


def ingest_csv(spark: SparkSession, feed: FeedSpec) -> None:
    """The stream carries file names only; each batch looks up their headers, a buffer of each
    file, and then reads the files once, with a scan per distinct header.

    The rows lie in a table of their own with a ``_batch_id`` partition per batch and checkpoint,
    which makes a replayed batch write to its old place. Users read the view over it, which has
    the columns that a JSON feed's table has.
    """
    schema = feed_schema(spark, feed)
    stored = f"{feed.table}__files"
    create_table(spark, stored, bronze_schema(schema).add(BATCH_ID, "string"), (BATCH_ID,))
    if not spark.catalog.tableExists(feed.table):
        columns = ", ".join(quoted(n) for n in bronze_schema(schema).names)
        publish_view(spark, feed.table, f"SELECT {columns} FROM {stored}", {STORED_IN: stored})
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .options(**file_options(feed))
        .load(feed.path)
        .filter("length > 0")
        .select("path")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        stream_spark = batch.sparkSession
        partition = f"{stream_identity(stream_spark, feed.checkpoint)}-{batch_id}"
        if partition_exists(stream_spark, stored, partition):
            return
        # Bounded by files_per_batch: the names of this batch's files.
        paths = [row["path"] for row in batch.collect()]
        with session_conf(stream_spark, {"spark.sql.caseSensitive": "true"}):
            try:
                write(stream_spark, paths, partition)
            except Exception as failure:
                if not too_wide(failure):
                    raise
                # Some row has more fields than the reader made room for; such a batch is read again.
                write(stream_spark, paths, partition, widest_row(stream_spark, paths))

    def write(stream_spark: SparkSession, paths: list[str], partition: str, widest: int = WIDEST_ROW) -> None:
        rows = read_any_header(stream_spark, paths, schema, widest) if paths else None
        if rows is not None:
            bronze = bronze_rows(rows, schema).withColumn(BATCH_ID, F.lit(partition))
            overwrite_partitions(bronze, stored)

    drain(files, feed.name, feed.checkpoint, stored, load)


def bronze_schema(schema: StructType) -> StructType:
    audit = {RESCUED: "string", CREATED_AT: "timestamp", SOURCE_FILE: "string"}
    whole = StructType(list(schema))
    for name, kind in audit.items():
        whole = whole.add(name, kind)
    return whole


def bronze_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    return with_created_at(rows).selectExpr(*[quoted(n) for n in bronze_schema(schema).names])


def partition_exists(spark: SparkSession, table: str, batch_id: str) -> bool:
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({BATCH_ID} = '{batch_id}')")
    return not found.isEmpty()
