"""Type 2 dimension merge as a DataFrame-to-DataFrame operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.catalog import quoted
from strata.functions.scalars import ACTIVE, END_DATE, INACTIVE, STATUS



def staged_union(batch: DataFrame, key: str, merge_key: str = "merge_id") -> DataFrame:
    """Each row twice, in one pass: once under its key, to close, and once under NULL, to insert."""
    no_key = F.lit(None).cast(batch.schema[key].dataType)
    return batch.withColumn(merge_key, F.explode(F.array(F.col(quoted(key)), no_key)))


def free_name(base: str, taken: Iterable[str]) -> str:
    """``base`` with as many underscores before it as make it differ from all names."""
    taken = {name.lower() for name in taken}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def delivered_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct non-null keys of a batch, as ``_key0``, ``_key1``…, each with its ``_copies``.

    Counted map-side before the shuffle, so a key that fills a third of the batch moves as one
    row per task.
    """
    named = [F.col(quoted(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
    rows = batch.filter(~_missing(keys)).select(*named)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))


def _missing(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(quoted(k)).isNull() for k in keys])


def close_versions(
    target: DataFrame,
    delivered: DataFrame,
    keys: Sequence[str],
    effective_date: date | None = None,
) -> DataFrame:
    """The target with the active versions of all delivered keys closed.

    Only active versions with a key join; the rest can match nothing and passes by, unshuffled. A
    key that is active in the target and was delivered more than once is ambiguous and fails the
    query, whatever is made of the result.
    """
    closing_day = F.current_date() if effective_date is None else F.lit(effective_date)
    open_now = F.coalesce(F.col(STATUS) == ACTIVE, F.lit(False)) & ~_missing(keys)
    names = {c: free_name(c, target.columns) for c in (*delivered.columns, "_spread")}
    matches = delivered.withColumnsRenamed({c: names[c] for c in delivered.columns})
    # One more join column than ``delivered_keys`` groups by makes Spark shuffle its result for the
    # join; if it reused the grouping's partitions, the adaptive skew join would not apply.
    matched = [names[f"_key{i}"] for i in range(len(keys))]
    matches = matches.withColumn(names["_spread"], F.xxhash64(*matched))
    own_spread = F.xxhash64(*[F.col(quoted(k)) for k in keys])
    on = [F.col(quoted(k)) == F.col(m) for k, m in zip(keys, matched, strict=True)]
    joined = target.filter(open_now).join(matches, [*on, own_spread == F.col(names["_spread"])], "left")
    copies = F.col(names["_copies"])
    message = F.concat_ws(
        " ",
        F.lit("more than one row of the batch updates the active version of key"),
        *[F.col(quoted(k)).cast("string") for k in keys],
    )
    refuse = F.when(copies > 1, F.raise_error(message).cast("boolean"))
    hit = copies.isNotNull()
    closed = {
        END_DATE: F.when(hit, closing_day).otherwise(F.col(END_DATE)),
        STATUS: F.when(hit, F.lit(INACTIVE)).otherwise(F.col(STATUS)),
    }
    columns = [closed.get(c, F.col(quoted(c))).alias(c) for c in target.columns]
    return joined.filter(refuse.otherwise(True)).select(*columns).unionAll(target.filter(~open_now))


def open_versions(batch: DataFrame, keys: Sequence[str], schema: StructType) -> DataFrame:
    """Every delivered row as a new version; a row with a NULL key comes twice."""
    times = F.when(_missing(keys), 2).otherwise(1)
    copy = free_name("_copy", schema.names)
    return batch.select(
        *[F.col(quoted(f.name)).cast(f.dataType) for f in schema],
        F.explode(F.array_repeat(F.lit(True), times)).alias(copy),
    ).drop(copy)


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    effective_date: date | None = None,
    delivered: DataFrame | None = None,
) -> DataFrame:
    """Close the active versions of every delivered key and insert every delivered row.

    There is no change detection: a row delivered again unchanged opens a new version. Keys the
    batch does not hold stay as they are. NULL keys match nothing, see ``open_versions``.

    The active target is joined to the distinct keys only, which Spark broadcasts if they are
    small and otherwise shuffles, splitting hot keys of the target. Closed rows, and rows without a
    key, are read apart from it; a target kept by status need not read anything twice. Callers
    that run this on a large target pass ``delivered`` as a materialised cache of
    ``delivered_keys(batch, keys)``, whose exact size the planner then knows.
    """
    if delivered is None:
        delivered = delivered_keys(batch, keys)
    closed = close_versions(target, delivered, keys, effective_date)
    return closed.unionByName(open_versions(batch, keys, target.schema))
