import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citegrid.llm import cover_tree, topk_search

def is_query():
    return F.pmod("vec_id", F.lit(50)) == 0


def brute(rows, k=5):
    best = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, v), v)
    q = {i: [math.floor(256 * x) for x in v] for i, v in best.items()}
    out = []
    for i, v in q.items():
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in q.items() if j != i and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("clusters", [0, 8])
def test_equals_brute_force(spark, clusters):
    rng = np.random.default_rng(clusters)
    centres = rng.normal(0, .2, (max(1, clusters), 12))
    x = rng.normal(0, .2, (700, 12)) if not clusters else centres[rng.integers(0, clusters, 700)] + rng.normal(0, .01, (700, 12))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    old = topk_search.BLOCK, topk_search.QUERY_BLOCK
    topk_search.BLOCK, topk_search.QUERY_BLOCK = 100, 5
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert found(topk_search.search(df, is_query())) == brute(rows)
    finally:
        topk_search.BLOCK, topk_search.QUERY_BLOCK = old


def test_odd_rows(spark):
    same = [.5, -.25]
    rows = [(i, same) for i in range(0, 160)] + [(0, same), (50, [9., 9.]), (500, None), (501, []), (502, [1., None]), (503, [float("nan"), 1.]),
            (504, [float("inf"), 1.]), (550, [1., 2., 3.]), (551, [1., 2., 3.]), (600, [1., 2., 3., 4.]), (None, same), (-50, [-1., -1.])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, q int")
    assert found(topk_search.search(df, is_query())) == brute(rows)


def test_huge_components(spark):
    rows = [(0, [1e12, 1.]), (1, [1e12, 3.]), (2, [1e12, 2.]), (3, [-1e12, 2.])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(topk_search.search(df, is_query()))
    assert [(r, j) for _, r, j, _ in got][-1] == (3, 3) and got[0][3] == 2 ** 63 - 1     # held at the ends of a long


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.search(df, is_query()).count() == 0
    assert topk_search.search(spark.createDataFrame([(1, [1.])], "vec_id long, embedding array<float>"), is_query()).count() == 0


def test_prunes_clustered_points():
    rng = np.random.default_rng(0)
    x = np.floor(256 * (rng.normal(0, .125, (30, 64))[rng.integers(0, 30, 3000)] + rng.normal(0, .01, (3000, 64))))
    ids = np.arange(3000)
    queries, tree = cover_tree.build(x[::50], ids[::50]), cover_tree.build(x, ids)
    best = cover_tree.Best.new(60, 5)
    taken = cover_tree.search(queries, tree, best, np.full(60, cover_tree.NONE))
    assert taken < 0.6 * 60 * 3000
