"""Nearest neighbours by randomly rotated one-bit codes: estimates of the inner product from packed
bits and correction scalars choose, by their error bounds, the vectors to be ranked exactly."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import vectors
from strata.llm.common import written


@dataclass(frozen=True)
class Params:
    k: int = 20
    #: Standard deviations of the estimate's error that the bound covers.
    slack: float = 3.0
    #: Bits of a component of the rotated query.
    query_bits: int = 6
    queries_per_block: int = 512
    rows_per_block: int = 8192
    seed: int = 5


@lru_cache(maxsize=4)
def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    square = np.random.default_rng(seed).standard_normal((dimension, dimension))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as little-endian words of 64 bits."""
    room = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, room))), axis=1, bitorder="little").view("<u8")


def code(ids: np.ndarray, matrix: np.ndarray, params: Params) -> dict[str, bytes]:
    """Of each vector: signs of its rotated components, its length, and the inner product of the
    unit vector with its code's unit vector, by which an estimate is corrected."""
    lengths = np.linalg.norm(matrix, axis=1)
    turned = matrix @ rotation(matrix.shape[1], params.seed).T / lengths[:, None]
    corrections = np.abs(turned).sum(axis=1) / np.sqrt(matrix.shape[1])
    return {
        "ids": ids.tobytes(),
        "codes": pack_bits(turned > 0).tobytes(),
        "lengths": lengths.astype("<f8").tobytes(),
        "corrections": corrections.astype("<f8").tobytes(),
        "vectors": matrix.tobytes(),
    }


def estimates(query: np.ndarray, codes: np.ndarray, ones: np.ndarray, corrections: np.ndarray, params: Params):
    """Cosines of the query with the coded vectors, and the error that each may have.

    The rotated query's components become small whole numbers, whose bit planes meet the codes by
    AND and bit counts.
    """
    d = len(query)
    turned = rotation(d, params.seed) @ (query / np.linalg.norm(query))
    low, top = turned.min(), (1 << params.query_bits) - 1
    step = max((turned.max() - low) / top, 1e-300)
    whole = np.rint((turned - low) / step).astype(np.int64)
    planes = pack_bits(((whole[None, :] >> np.arange(params.query_bits)[:, None]) & 1).astype(bool))
    total = np.zeros(len(codes), np.int64)
    for b, plane in enumerate(planes):
        total += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << b
    root = np.sqrt(d)
    product = (2 * step * total + 2 * low * ones - step * whole.sum() - d * low) / root
    wide = np.sqrt(np.maximum(1 - corrections**2, 0) / max(d - 1, 1)) + step / np.sqrt(12)
    return product / corrections, params.slack * wide / corrections


def search(rows: DataFrame, queries: DataFrame, params: Params = Params(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each query its k largest inner products among the rows but its own: query_id, rank,
    vec_id, score (in double precision, on the original vectors).

    Vectors that are NULL, zero or hold NULL or infinite or undefined components take no part, nor
    do rows without a key. A query meets the rows of its dimension. Rows that repeat a key with other
    vectors all count, as candidates and as queries with k rows each; equal rows count once.
    Every vector is coded and estimated; only ranking is limited, by the error bounds.
    """
    nonzero = F.exists("vector", lambda x: x != 0)
    stored = vectors.usable(rows, key, vector, nonzero)
    asked = vectors.in_turn(vectors.usable(queries, key, vector, nonzero))
    plain = lambda ids, matrix: {"ids": ids.tobytes(), "vectors": matrix.tobytes()}
    coded = lambda ids, matrix: code(ids, matrix, params)
    index = vectors.blocks(
        stored, params.rows_per_block, coded, "ids binary, codes binary, lengths binary, corrections binary, vectors binary"
    )
    asked = vectors.blocks(asked, params.queries_per_block, plain, "ids binary, vectors binary")

    def compare(q: dict, x: dict) -> tuple:
        asked_ids, ids = (np.frombuffer(b, "<i8") for b in (q["ids"], x["ids"]))
        wanted = np.frombuffer(q["vectors"], "<f8").reshape(len(asked_ids), -1)
        matrix = np.frombuffer(x["vectors"], "<f8").reshape(len(ids), -1)
        codes = np.frombuffer(x["codes"], "<u8").reshape(len(ids), -1)
        lengths, corrections = (np.frombuffer(x[c], "<f8") for c in ("lengths", "corrections"))
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        out: tuple[list, list, list] = ([], [], [])
        for place, (own, query) in enumerate(zip(asked_ids, wanted, strict=True)):
            cosine, error = estimates(query, codes, ones, corrections, params)
            scale = lengths * np.linalg.norm(query)
            guess, most = cosine * scale, (cosine + error) * scale
            guess[ids == own] = most[ids == own] = -np.inf
            # The exact scores of the likeliest set the bar for the bounds of the rest.
            first = np.argpartition(guess, max(0, len(ids) - 3 * params.k))[-3 * params.k :]
            exact = matrix[first] @ query
            exact[ids[first] == own] = -np.inf
            bar = np.sort(exact)[-params.k] if len(exact) >= params.k else -np.inf
            at = np.flatnonzero((most >= bar) & (ids != own))
            scores = matrix[at] @ query
            top = vectors.best(scores, ids[at], params.k)
            out[0].append(np.full(len(top), place))
            out[1].append(ids[at][top])
            out[2].append(scores[top])
        return tuple(np.concatenate(c) for c in out)

    return vectors.search(written(asked, "queries"), written(index, "index"), compare, params.k, "double")
