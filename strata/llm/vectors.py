"""Vectors in blocks: a row for some thousand vectors, so that a search compares block with block."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_batches, written

FOUND = "query_id long, turn int, vec_id long, score {}"


def finite(vector: str) -> Column:
    """Whether there is a vector and all its components are finite numbers."""
    inside = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, inside)


def usable(rows: DataFrame, key: str, vector: str, also: Column | None = None) -> DataFrame:
    """(id, vector) of the rows that take part, written once: those with a key and a finite vector,
    of any dimension. Equal rows are one; a key may have several vectors."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = rows.select(F.col(key).cast("long").alias("id"), doubles.alias("vector"))
    fine = fine.where(F.col("id").isNotNull() & finite("vector") & (F.lit(True) if also is None else also))
    return written(fine.distinct(), "vectors")


def in_turn(queries: DataFrame) -> DataFrame:
    """Adds `turn`, which tells the vectors of a key apart."""
    turn = F.row_number().over(Window.partitionBy("id").orderBy("vector"))
    return written(queries.withColumn("turn", turn), "turns")


def blocks(rows: DataFrame, per_block: int, encode: Callable[[np.ndarray, np.ndarray], dict[str, bytes]], columns: str) -> DataFrame:
    """Rows (id, vector) as blocks of `per_block` or fewer of one dimension; `encode` makes a block's
    columns from its ids and its matrix of doubles. Besides, a block has its dimension, and for
    queries their turns, as bytes."""
    parts = max(1, math.ceil(rows.count() / per_block))
    turns = "turn" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            sizes = pc.list_value_length(table["vector"]).to_numpy()
            for size in np.unique(sizes):
                alike = table.filter(pa.array(sizes == size)).combine_chunks()
                ids = alike["id"].to_numpy()
                matrix = alike["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
                block = encode(ids.astype("<i8"), matrix.astype("<f8")) | {"dimension": int(size).to_bytes(8, "little")}
                if turns:
                    block["turns"] = alike["turn"].to_numpy().astype("<i4").tobytes()
                yield pa.RecordBatch.from_pylist([block])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for piece in (batch.slice(k, per_block) for k in range(0, batch.num_rows, per_block)):
                if held and sum(b.num_rows for b in held) + piece.num_rows > per_block:
                    yield from ready()
                    held = []
                held.append(piece)
        if held:
            yield from ready()

    return map_batches(rows.repartition(parts), run, columns + ", dimension binary" + ", turns binary" * turns)


def search(queries: DataFrame, index: DataFrame, compare: Callable[[dict, dict], tuple], k: int, kind: str) -> DataFrame:
    """The k best of all: each block of queries meets each block of the index of its dimension, which
    leaves k rows for a query; these are ranked by score, ties by smaller id. `compare` tells a query
    by its place in its block.

    The queries are a stated set; the product is one of blocks, not of rows.
    """
    given, stored = queries.columns, index.columns
    pairs = queries.select([F.col(c).alias(f"q_{c}") for c in given]).crossJoin(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cells = {c: batch.column(i)[row].as_buffer() for i, c in enumerate(batch.schema.names)}
                if not cells["q_dimension"].equals(cells["dimension"]):
                    continue
                asked = {c: cells[f"q_{c}"] for c in given}
                q, v, s = compare(asked, {c: cells[c] for c in stored})
                ids, turns = np.frombuffer(asked["ids"], "<i8")[q], np.frombuffer(asked["turns"], "<i4")[q]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, turns, v, s)], ["query_id", "turn", "vec_id", "score"])

    found = map_batches(pairs, run, FOUND.format(kind))
    best = Window.partitionBy("query_id", "turn").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id, in order: selection, then a sort of
    what reaches the k-th score."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]
