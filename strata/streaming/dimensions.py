"""Type 2 dimensions kept up to date from micro-batches.

Layout: one table ``<name>__versions`` partitioned by batch, status and bucket, and the view
``<name>`` that users read. The active versions lie in buckets by key. Batch *n* rewrites only the
buckets of its keys, as partitions of batch *n*; all other rows are appended to bucket -1 and never
joined again: the versions the batch closed, and rows without a key, which nothing can close. When
some batches have come together, their rows in bucket -1 are folded into bucket -2, so that
partitions do not pile up. A batch that finds another number of buckets declared rewrites them all.
Replacing the view then publishes all of it at once, and its properties
record which batch of which checkpoint it shows, at which batch it was folded, and how many buckets it has
since which batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.catalog import (
    as_schema,
    conform,
    create_table,
    overwrite_partitions,
    properties,
    publish_view,
    quoted,
    stream_of,
)
from strata.functions.scalars import (
    ACTIVE,
    BATCH_ID,
    BUCKET,
    INACTIVE,
    STATUS,
    with_version_columns,
)
from strata.operators.scd2 import delivered_keys, open_versions, scd2_merge
from strata.session import join_settings, session_conf
from strata.streaming.drain import drain, stream_identity

BATCH_MARK = "strata.batch"
STREAM_MARK = "strata.stream"
BUCKETS_MARK = "strata.buckets"
FOLD_MARK = "strata.folded"
SPLIT_MARK = "strata.split"
NO_BATCH = -1
FINAL = -1
FOLDED = -2


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension fed by a bronze table. ``clean`` prepares the business columns.

    A batch rewrites the active versions in the buckets of its keys. One bucket suits dimensions
    whose batches touch keys all over; a large one with narrow batches takes some hundred. As it
    grows, declare more: the next batch with rows deals its active versions anew, a copy of them all.

    ``files_per_batch`` has a say in the outcome: an active key that comes twice within one batch
    is refused, in two batches it makes two versions.

    ``keep`` copies of a bucket before the current one stay for readers that have planned on them.
    ``fold_after`` batches with closed rows are folded into one; a fold copies the history.
    """

    source: str
    table: str
    schema: str
    key: str
    checkpoint: str
    name: str
    clean: Callable[[DataFrame], DataFrame] | None = None
    files_per_batch: int = 1000
    buckets: int = 1
    keep: int = 1
    fold_after: int = 16

    @property
    def versions(self) -> str:
        return f"{self.table}__versions"

    def bucket(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(quoted(key or self.key))), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Copies:
    """What the table holds: by bucket the batches that wrote it, oldest first."""

    batches: dict[int, list[int]]

    def newest(self, bucket: int, batch_id: int, since: int = NO_BATCH) -> int | None:
        """The last batch that wrote a bucket, of those since the buckets are as many as they are."""
        return max((b for b in self.batches.get(bucket, []) if since <= b <= batch_id), default=None)


def stored_partitions(spark: SparkSession, dim: DimensionSpec, spec: str = "") -> list[tuple[int, str, int]]:
    """Batch, status and bucket of each partition; a bounded number, see ``fold_after``."""
    clause = f"PARTITION ({spec})" if spec else ""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {dim.versions} {clause}").collect():
        values = dict(part.split("=") for part in row["partition"].split("/"))
        found.append((int(values[BATCH_ID]), values[STATUS], int(values[BUCKET])))
    return found


def drop_partitions(spark: SparkSession, dim: DimensionSpec, gone: list[tuple[int, str, int]]) -> None:
    """Drops any number of partitions in one statement."""
    specs = ", ".join(
        f"PARTITION ({BATCH_ID} = '{batch}', {STATUS} = '{status}', {BUCKET} = '{bucket}')"
        for batch, status, bucket in gone
    )
    if gone:
        spark.sql(f"ALTER TABLE {dim.versions} DROP IF EXISTS {specs}")


def copies_of(partitions: list[tuple[int, str, int]]) -> Copies:
    batches = defaultdict(set)
    for batch, _, bucket in partitions:
        batches[bucket].add(batch)
    return Copies({bucket: sorted(own) for bucket, own in batches.items()})


def bucket_copies(spark: SparkSession, dim: DimensionSpec) -> dict[int, list[int]]:
    """The batches that wrote each bucket of active versions, oldest first."""
    found = copies_of(stored_partitions(spark, dim)).batches
    return {bucket: batches for bucket, batches in found.items() if bucket >= 0}


def current_buckets(copies: Copies, batch_id: int, buckets: Iterable[int], since: int) -> str:
    """SQL that picks the copies of the buckets that are current at a batch; plain comparisons,
    which a metastore can prune by."""
    by_batch = defaultdict(list)
    for bucket in buckets:
        newest = copies.newest(bucket, batch_id, since)
        if newest is not None:
            by_batch[newest].append(str(bucket))
    picks = [f"({BATCH_ID} = {b} AND {BUCKET} IN ({', '.join(own)}))" for b, own in sorted(by_batch.items())]
    return " OR ".join(picks) or "false"


def history(folded: int, batch_id: int) -> str:
    """SQL that picks the rows that are final: the folded ones and those of the batches since."""
    since = f"({BUCKET} = {FINAL} AND {BATCH_ID} > {folded} AND {BATCH_ID} <= {batch_id})"
    return since if folded == NO_BATCH else f"({BUCKET} = {FOLDED} AND {BATCH_ID} = {folded}) OR {since}"


def publish(spark: SparkSession, dim: DimensionSpec, batch_id: int, marks: dict[str, str]) -> None:
    columns = ", ".join(quoted(f.name) for f in as_schema(dim.schema))
    copies = copies_of(stored_partitions(spark, dim))
    folded = int(marks.get(FOLD_MARK, NO_BATCH))
    buckets, since = int(marks.get(BUCKETS_MARK, dim.buckets)), int(marks.get(SPLIT_MARK, NO_BATCH))
    active = current_buckets(copies, batch_id, range(buckets), since)
    query = f"SELECT {columns} FROM {dim.versions} WHERE {history(folded, batch_id)} OR {active}"
    own = {BATCH_MARK: batch_id, BUCKETS_MARK: buckets, FOLD_MARK: folded, SPLIT_MARK: since}
    publish_view(spark, dim.table, query, {**marks, **{mark: str(value) for mark, value in own.items()}})


def create_dimension(spark: SparkSession, dim: DimensionSpec) -> None:
    schema = as_schema(dim.schema)
    stored = StructType([f for f in schema if f.name != STATUS])
    stored = stored.add(BATCH_ID, "long").add(STATUS, "string").add(BUCKET, "integer")
    create_table(spark, dim.versions, stored, (BATCH_ID, STATUS, BUCKET))
    if not spark.catalog.tableExists(dim.table):
        publish(spark, dim, NO_BATCH, {})


def merge_batch(
    dim: DimensionSpec,
    batch: DataFrame,
    batch_id: int,
    stream: str,
    effective_date: date | None = None,
) -> None:
    """Merge one micro-batch and publish the result; a replayed batch changes nothing."""
    spark = batch.sparkSession
    marks = properties(spark, dim.table)
    committed = int(marks[BATCH_MARK])
    if marks.get(STREAM_MARK, stream) != stream:
        raise RuntimeError(
            f"{dim.table} was built from another checkpoint; merging from a new one would "
            "deliver every row again"
        )
    if batch_id <= committed:
        return
    if committed == NO_BATCH and batch_id > 0 and STREAM_MARK not in marks:
        raise RuntimeError(f"{dim.table} is empty but its checkpoint is at batch {batch_id}")
    folded = int(marks.get(FOLD_MARK, NO_BATCH))
    buckets, since = int(marks[BUCKETS_MARK]), int(marks.get(SPLIT_MARK, NO_BATCH))
    if batch.isEmpty():
        publish(spark, dim, committed, {**marks, STREAM_MARK: stream})
        return

    drop_partitions(spark, dim, stored_partitions(spark, dim, f"{BATCH_ID} = {batch_id}"))
    stored = spark.table(dim.versions)
    if committed == NO_BATCH:
        schema = stored.drop(BATCH_ID, BUCKET).schema
        write_versions(dim, open_versions(batch, [dim.key], schema), batch_id)
    else:
        delivered = delivered_keys(batch, [dim.key]).persist()
        try:
            # At most one row per bucket; this also fills the cache, so its size is known.
            touched = [row[0] for row in delivered.select(dim.bucket("_key0")).distinct().collect()]
            copies = copies_of(stored_partitions(spark, dim))
            # Where the number changes, every active version moves, with this batch's.
            read = touched if buckets == dim.buckets else range(buckets)
            active = stored.filter(f"{STATUS} = '{ACTIVE}'").filter(current_buckets(copies, committed, read, since))
            merged = scd2_merge(active.drop(BATCH_ID, BUCKET), batch, [dim.key], effective_date, delivered)
            write_versions(dim, merged, batch_id)
        finally:
            delivered.unpersist()
    now_folded = fold(spark, dim, folded, batch_id)
    now_since = since if buckets == dim.buckets else batch_id
    own = {STREAM_MARK: stream, FOLD_MARK: now_folded, BUCKETS_MARK: dim.buckets, SPLIT_MARK: now_since}
    publish(spark, dim, batch_id, {mark: str(value) for mark, value in own.items()})
    drop_superseded(spark, dim, folded, now_folded, batch_id, now_since)


def fold(spark: SparkSession, dim: DimensionSpec, folded: int, batch_id: int) -> int:
    """Copies the final rows of many batches together; the batch up to which that is done."""
    finals = copies_of(stored_partitions(spark, dim)).batches.get(FINAL, [])
    if sum(folded < batch <= batch_id for batch in finals) <= dim.fold_after:
        return folded
    rows = spark.table(dim.versions).filter(history(folded, batch_id))
    kept = rows.withColumns({BATCH_ID: F.lit(batch_id).cast("long"), BUCKET: F.lit(FOLDED)})
    overwrite_partitions(kept.select(*rows.columns), dim.versions)
    return batch_id


def write_versions(dim: DimensionSpec, versions: DataFrame, batch_id: int) -> None:
    spark = versions.sparkSession
    final = (F.col(STATUS) == INACTIVE) | F.col(quoted(dim.key)).isNull()
    rows = versions.withColumns(
        {
            BATCH_ID: F.lit(batch_id).cast("long"),
            BUCKET: F.when(final, FINAL).otherwise(dim.bucket()),
        }
    )
    with session_conf(spark, join_settings(spark)):
        if dim.buckets > 1:
            # A few big files per bucket rather than one per bucket and task; split if skewed.
            rows = rows.hint("rebalance", BUCKET)
        overwrite_partitions(rows.select(*spark.table(dim.versions).columns), dim.versions)


def drop_superseded(
    spark: SparkSession, dim: DimensionSpec, folded: int, now_folded: int, batch_id: int, since: int
) -> None:
    """Drops copies of buckets that no reader of the last ``keep`` versions needs, also those from
    before the buckets became as many as they are.

    Rows folded just now stay where they were until the next fold, for the same readers.
    """
    partitions = stored_partitions(spark, dim)
    copies = copies_of(partitions).batches

    def needed(batch: int, bucket: int) -> bool:
        if bucket == FINAL:
            return batch > folded or now_folded == folded == NO_BATCH
        if bucket >= 0 and batch < since <= batch_id - dim.keep:
            return False
        return batch in copies[bucket][-(dim.keep + 1) :]

    drop_partitions(spark, dim, [p for p in partitions if not needed(p[0], p[2])])


def merge_dimension(
    spark: SparkSession, dim: DimensionSpec, effective_date: date | None = None
) -> None:
    """Drain the bronze table into the dimension."""
    create_dimension(spark, dim)
    bronze = stream_of(spark, dim.source, dim.files_per_batch)
    cleaned = dim.clean(bronze) if dim.clean else bronze
    rows = conform(with_version_columns(cleaned), dim.schema)

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(batch.sparkSession, dim.checkpoint)
        merge_batch(dim, batch, batch_id, stream, effective_date)

    drain(rows, dim.name, dim.checkpoint, dim.versions, merge)
