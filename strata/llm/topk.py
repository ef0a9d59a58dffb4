"""Exact top-k search by term-at-a-time accumulation over postings."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from strata.llm import vectors
from strata.llm.common import written


@dataclass(frozen=True)
class Params:
    k: int = 5
    #: Weights are floor(scale * component).
    scale: int = 256
    queries_per_block: int = 256
    rows_per_block: int = 8192


def postings(ids: np.ndarray, matrix: np.ndarray, params: Params) -> dict[str, bytes]:
    """A block by term: where each term's list ends, places of the rows that hold it, their weights."""
    weights = np.floor(params.scale * matrix).astype("<i8")
    terms, places = np.nonzero(weights.T)
    ends = np.cumsum(np.bincount(terms, minlength=matrix.shape[1]))
    return {
        "ids": ids.tobytes(),
        "ends": ends.astype("<i8").tobytes(),
        "places": places.astype("<i4").tobytes(),
        "weights": weights[places, terms].astype("<i8").tobytes(),
    }


def sparse_rows(ids: np.ndarray, matrix: np.ndarray, params: Params) -> dict[str, bytes]:
    """A block of queries by row: where each row ends, its terms, their weights."""
    weights = np.floor(params.scale * matrix).astype("<i8")
    rows, terms = np.nonzero(weights)
    ends = np.cumsum(np.bincount(rows, minlength=len(ids)))
    return {
        "ids": ids.tobytes(),
        "ends": ends.astype("<i8").tobytes(),
        "terms": terms.astype("<i4").tobytes(),
        "weights": weights[rows, terms].astype("<i8").tobytes(),
    }


def lists(ends: np.ndarray, *flat: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    return [tuple(f[a:b] for f in flat) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def search(rows: DataFrame, queries: DataFrame, params: Params = Params(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each query its k largest integer inner products among the rows but its own, exactly:
    query_id, rank, vec_id, score.

    Vectors that are NULL or hold NULL or infinite or undefined components take no part, nor do
    rows without a key. A query meets the rows of its dimension. Rows that repeat a key with other
    vectors all count, as candidates and as queries with k rows each; equal rows count once. A zero
    vector takes part, with scores of 0. Scores wrap as Spark's long does.
    """
    stored, asked = vectors.usable(rows, key, vector), vectors.in_turn(vectors.usable(queries, key, vector))
    index = vectors.blocks(
        stored, params.rows_per_block, lambda i, m: postings(i, m, params), "ids binary, ends binary, places binary, weights binary"
    )
    asked = vectors.blocks(
        asked, params.queries_per_block, lambda i, m: sparse_rows(i, m, params), "ids binary, ends binary, terms binary, weights binary"
    )

    def compare(q: dict, x: dict) -> tuple:
        asked_ids, ids, q_ends, x_ends = (np.frombuffer(b, "<i8") for b in (q["ids"], x["ids"], q["ends"], x["ends"]))
        wanted = lists(q_ends, np.frombuffer(q["terms"], "<i4"), np.frombuffer(q["weights"], "<i8"))
        held = lists(x_ends, np.frombuffer(x["places"], "<i4"), np.frombuffer(x["weights"], "<i8"))
        scores, step = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        out: tuple[list, list, list] = ([], [], [])
        for place, (own, (terms, weights)) in enumerate(zip(asked_ids, wanted, strict=True)):
            scores[:] = 0
            for term, weight in zip(terms, weights, strict=True):
                places, values = held[term] if term < len(held) else ((), ())
                if len(places) == len(ids):  # every row holds the term: no need to scatter
                    np.add(scores, np.multiply(values, weight, out=step), out=scores)
                elif len(places):
                    scores[places] += values * weight
            at = np.flatnonzero(ids != own)
            at = at[vectors.best(scores[at], ids[at], params.k)]
            out[0].append(np.full(len(at), place))
            out[1].append(ids[at])
            out[2].append(scores[at])
        return tuple(np.concatenate(c) for c in out)

    return vectors.search(written(asked, "queries"), written(index, "index"), compare, params.k, "long")
