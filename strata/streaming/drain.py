"""Start a stream, let it take all there is, and wait for the end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def drain(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    table: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append ``stream`` to ``table``, or hand its micro-batches to ``each_batch``.

    Returns the ended query when all available input is committed, and raises if it failed. The
    calling session then forgets the files it knew of ``table``.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.format("parquet").toTable(table)
    query.awaitTermination()
    if table is not None:
        stream.sparkSession.catalog.refreshTable(table)
    return query


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint gives its stream; a lost checkpoint comes back with another one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]
