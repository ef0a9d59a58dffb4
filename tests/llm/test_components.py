import random

from strata.llm.components import components


def test_paths_cliques_and_loops(spark):
    rng = random.Random(5)
    path = list(range(100, 160))
    rng.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(a, b) for a in range(5) for b in range(a)] + [(7, 8), (8, 7), (9, 9)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: 100 for n in range(101, 160)} | {n: 0 for n in range(1, 5)} | {8: 7}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
