"""A whole pipeline as data, and one call to run it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from strata.catalog import create_namespaces, replace_table
from strata.config import LayerConfig
from strata.operators.mart import MartSpec, build_mart
from strata.session import join_settings, session_conf
from strata.streaming.dimensions import DimensionSpec, merge_dimension
from strata.streaming.facts import FactSpec, append_fact
from strata.streaming.ingest import FeedSpec, feed_schema, ingest

Step = TypeVar("Step")


@dataclass(frozen=True)
class GoldSpec:
    lines: str
    headers: str
    products: str
    types: str
    table: str
    mart: MartSpec = field(default_factory=MartSpec)


@dataclass(frozen=True)
class Medallion:
    config: LayerConfig
    feeds: tuple[FeedSpec, ...]
    facts: tuple[FactSpec, ...]
    dimensions: tuple[DimensionSpec, ...]
    gold: GoldSpec


def gold_rows(spark: SparkSession, gold: GoldSpec) -> DataFrame:
    return build_mart(
        spark.table(gold.lines),
        spark.table(gold.headers),
        spark.table(gold.products),
        spark.table(gold.types),
        gold.mart,
    )


def create_gold(spark: SparkSession, gold: GoldSpec) -> None:
    with session_conf(spark, join_settings(spark)):
        replace_table(spark, gold.table, gold_rows(spark, gold))


def side_by_side(run: Callable[[Step], None], steps: Iterable[Step]) -> None:
    """Run independent streams at the same time; all are waited for, then a failure is raised."""
    steps = list(steps)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        for done in [pool.submit(run, step) for step in steps]:
            done.result()


def run_bronze(spark: SparkSession, plan: Medallion) -> None:
    create_namespaces(spark, plan.config)
    for feed in plan.feeds:
        feed_schema(spark, feed)
    side_by_side(lambda feed: ingest(spark, feed), plan.feeds)


def run_silver(spark: SparkSession, plan: Medallion, effective_date: date | None = None) -> None:
    create_namespaces(spark, plan.config)
    steps: list[Callable[[], None]] = [
        *(lambda fact=fact: append_fact(spark, fact) for fact in plan.facts),
        *(lambda dim=dim: merge_dimension(spark, dim, effective_date) for dim in plan.dimensions),
    ]
    side_by_side(lambda step: step(), steps)


def run_gold(spark: SparkSession, plan: Medallion) -> None:
    create_namespaces(spark, plan.config)
    create_gold(spark, plan.gold)


def run_pipeline(spark: SparkSession, plan: Medallion, effective_date: date | None = None) -> None:
    """Bring all layers up to date with the files that have arrived."""
    run_bronze(spark, plan)
    run_silver(spark, plan, effective_date)
    run_gold(spark, plan)
