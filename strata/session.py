"""Session settings the engine's wide joins rely on."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

LOCAL_MAP_BOUND = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

# Shuffle partitions per core that a join starts with; small ones are merged at run time.
PARTITIONS_PER_CORE = 3


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def user_set(spark: SparkSession, key: str) -> bool:
    """Whether the session has a value of its own for the key, be it the default one."""
    return not spark.sql("SET").filter(F.col("key") == key).isEmpty()


def join_settings(spark: SparkSession) -> dict[str, str]:
    """Adaptive execution, which splits skewed join partitions, and shuffles as wide as the
    cluster. What the user has set for the last two keys stays.

    Adaptive execution merges partitions that turn out small but cannot make more of them, so the
    default of 200 would leave partitions of hundreds of gigabytes in a join of 100 TB. Where all
    partitions of the smaller side turn out to fit the local map bound, it hashes them and spares
    both sides the sort.
    """
    cores = spark.sparkContext.defaultParallelism
    default = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS_PER_CORE * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        INITIAL_PARTITIONS: spark.conf.get(INITIAL_PARTITIONS, None) or str(default),
        LOCAL_MAP_BOUND: spark.conf.get(LOCAL_MAP_BOUND) if user_set(spark, LOCAL_MAP_BOUND) else "64MB",
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may leave that out; its warehouse folder is used then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`mapInArrow`, with this package on the path of the Python workers.

    A cluster that has it installed, or gets it by `--py-files`, needs no path; it does no harm.
    """
    worker_environment(df.sparkSession)
    return df.mapInArrow(run, schema)


def worker_environment(spark: SparkSession) -> None:
    """Settings of the Python workers: where this package is, and to give freed memory back, which
    counts as they live from task to task."""
    env = spark.sparkContext.environment
    root, paths = str(Path(__file__).resolve().parents[1]), env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    # Settings of the C library: blocks of 4 MB or more go back when they are freed.
    for setting, value in (("ARENA_MAX", 2), ("MMAP_THRESHOLD_", 4 << 20), ("TRIM_THRESHOLD_", 4 << 20)):
        env.setdefault(f"MALLOC_{setting}", str(value))
