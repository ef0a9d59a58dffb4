"""Both searches against all inner products."""

import math

import numpy as np
import pytest

from strata.llm import rabitq, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, score double, `rank` int, id string"


def frame(spark, vectors_by_id):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0.5, 1, "x") for i, v in vectors_by_id]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 40))
    found = [(i, (centres[i % 12] + 0.7 * rng.standard_normal(40)) * rng.uniform(0.2, 3)) for i in range(1500)]
    found += [(2000 + i, found[i % 7][1]) for i in range(40)]  # ties
    return [(i, v.astype(np.float32)) for i, v in found]


ODD = [(20, None), (40, [math.nan] * 40), (60, [math.inf] * 40), (80, [None] * 40), (100, [1.0, 2.0]), (120, []), (None, [1.0] * 40)]


def taken(rows):
    odd = {i for i, _ in ODD}
    return [(i, v) for i, v in rows if i not in odd]


def exact(rows, queries, matrix_of, k):
    ids, m = np.array([i for i, _ in rows]), matrix_of(np.stack([v for _, v in rows]).astype(float))
    out = {}
    for q in np.flatnonzero(np.isin(ids, queries)):
        scores = m @ m[q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_topk_is_exact(spark, rows):
    given = frame(spark, taken(rows) + ODD)
    params = topk.Params(queries_per_block=16, rows_per_block=300)
    found = by_query(topk.search(given, given.where("vec_id % 20 = 0"), params))
    assert found == exact(taken(rows), [i for i, _ in taken(rows) if i % 20 == 0], lambda m: np.floor(256 * m).astype(int), 5)


def test_topk_sparse_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(30) * (rng.random(30) < 0.1)) for i in range(300)]
    rows = [(i, v.astype(np.float32)) for i, v in rows]
    found = by_query(topk.search(frame(spark, rows), frame(spark, rows[:20])))
    assert found == exact(rows, list(range(20)), lambda m: np.floor(256 * m).astype(int), 5)


def test_nearest_by_codes(spark, rows):
    zero = [(140, [0.0] * 40)]
    kept = [(i, v) for i, v in taken(rows) if i != 140]
    given = frame(spark, kept + ODD + zero)
    found = by_query(rabitq.search(given, given.where("vec_id % 20 = 0"), rabitq.Params(queries_per_block=16, rows_per_block=300)))
    wanted = exact(kept, [i for i, _ in kept if i % 20 == 0], lambda m: m, 20)
    assert found.keys() == wanted.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.98 * sum(map(len, wanted.values()))
    scores = {q: {i: s for i, s in exact(kept, [q], lambda m: m, len(kept))[q]} for q in list(found)[:5]}
    assert all(abs(s - scores[q][i]) < 1e-9 for q in scores for i, s in found[q])


def test_bounds_hold_for_most(rows):
    matrix = np.stack([v for _, v in rows]).astype(float)
    params = rabitq.Params()
    block = rabitq.code(np.arange(len(matrix)), matrix, params)
    codes = np.frombuffer(block["codes"], "<u8").reshape(len(matrix), -1)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    corrections, lengths = (np.frombuffer(block[c], "<f8") for c in ("corrections", "lengths"))
    inside = []
    for q in matrix[:30]:
        cosine, error = rabitq.estimates(q, codes, ones, corrections, params)
        inside.append(np.abs(cosine - matrix @ q / lengths / np.linalg.norm(q)) <= error)
    assert np.mean(inside) > 0.99


def test_few_or_no_rows(spark):
    none = frame(spark, [])
    one = frame(spark, [(1, [1.0, 2.0])])
    three = frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])])
    for search in (rabitq.search, topk.search):
        assert search(none, none).collect() == []
        assert search(one, one).collect() == []
        assert search(three, none).collect() == []
        assert search(one, three).count() == 2
        assert [r.vec_id for r in search(three, three).where("query_id = 1").orderBy("rank").collect()] == [2, 3]


def test_each_dimension_and_each_vector_of_a_key(spark):
    rows = [(1, [1, 2, 3]), (2, [2, 2, 2]), (3, [3, 1, 1]), (4, [1, 2]), (5, [2, 1]), (5, [4, 4]), (6, [1, 0]), (6, [0, 1])]
    given = frame(spark, rows)
    for search, scale in ((rabitq.search, 1), (topk.search, 256 * 256)):
        found = search(given, given.where("vec_id IN (1, 4, 6)"))
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score / scale) for r in found.collect())
        assert [(q, k, v, round(s, 9)) for q, k, v, s in got] == sorted(
            [(1, 1, 2, 12), (1, 2, 3, 8), (4, 1, 5, 12), (4, 2, 5, 4), (4, 3, 6, 2), (4, 4, 6, 1)]
            + [(6, 1, 5, 4), (6, 2, 5, 2), (6, 3, 4, 1), (6, 1, 5, 4), (6, 2, 4, 2), (6, 3, 5, 1)]
        )


def test_best_breaks_ties_by_id():
    scores, ids = np.array([3, 5, 5, 5, 1]), np.array([9, 8, 2, 4, 1])
    assert ids[vectors.best(scores, ids, 2)].tolist() == [2, 4]
    assert ids[vectors.best(scores, ids, 9)].tolist() == [2, 4, 8, 9, 1]
