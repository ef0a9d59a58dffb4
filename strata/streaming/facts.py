"""Typed silver fact tables, appended from a bronze table read as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.catalog import conform, create_table, stream_of
from strata.functions.scalars import drop_technical
from strata.streaming.drain import drain


@dataclass(frozen=True)
class FactSpec:
    source: str
    table: str
    schema: str
    checkpoint: str
    name: str
    files_per_batch: int = 1000


def append_fact(spark: SparkSession, fact: FactSpec) -> StreamingQuery:
    create_table(spark, fact.table, fact.schema)
    bronze = stream_of(spark, fact.source, fact.files_per_batch)
    rows = conform(drop_technical(bronze), fact.schema)
    return drain(rows, fact.name, fact.checkpoint, fact.table)
