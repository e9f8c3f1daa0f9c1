import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citegrid.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def is_anchor():
    return F.col("vec_id") % 100 == 0


def clamp(x):
    return max(-2 ** 63 + 1, min(2 ** 63 - 1, x))


def brute(rows, positives=5, negatives=10, low=30, high=90):
    v = [(i, label, [math.floor(256 * x) for x in e]) for i, label, e in rows
         if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (i, label, q) in enumerate(v):
        if i % 100:
            continue
        scored = [(-clamp(sum(x * y for x, y in zip(q, w))), j, other) for b, (j, other, w) in enumerate(v) if b != a and len(w) == len(q)]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fits = sorted((t, j) for t, j, other in scored if other != label and -low * s <= -100 * t <= -high * s)
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(fits[:negatives])]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,block,tile", [(0, 64, 3), (1, 4096, 128)])
def test_equals_brute_force(spark, seed, block, tile, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "TILE", tile)
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, .15, (6, 20))
    x = centres[rng.integers(0, 6, 900)] + rng.normal(0, .12, (900, 20))
    x[::17] = x[0]                                   # ties
    rows = [(i, int(rng.integers(0, 4)), [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(i, label, e, "c", 1) for i, label, e in rows], "vec_id long, label int, embedding array<double>, block string, row int")
    want = brute(rows)
    assert found(hn.mine(df, is_anchor())) == want and len(want) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [.5, -.25]
    rows = ([(i, i % 3, same) for i in range(0, 210)] + [(0, 0, same), (100, 1, [.4, 0.]), (100, 1, [.4, 0.]), (300, None, same), (301, 1, None), (302, 1, []),
            (400, 1, [1., None]), (401, 1, [nan, 1.]), (402, 1, [inf, 1.]), (500, 1, [1., 2., 3.]), (501, 1, [1., 2., 3.]), (502, 2, [.7, 1., 2.]), (600, 9, [1.] * 4),
            (None, 1, same), (-100, 1, [-1., -1.]), (503, 1, [0., 0.]), (700, 5, [0., 0.]), (701, 5, [0., 0.]), (702, 5, [1., 1.])]
            + [(i, 1 + i % 2, [.4 - .01 * (i % 30), .1]) for i in range(800, 860)])
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = brute(rows)
    assert found(hn.mine(df, is_anchor())) == want and want


def test_huge_components(spark):
    rows = [(0, 1, [1e12, 1.]), (1, 1, [1e12, 3.]), (2, 2, [1e6, 2.]), (3, 2, [-1e12, 2.]), (4, 2, [5e11, 0.])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert found(hn.mine(df, is_anchor())) == brute(rows)


def test_index_keeps_every_score_above():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 60, (500, 24)) * np.linspace(2, .1, 24))
    x[::9] = np.floor(x[::9] / 40)
    q = np.floor(rng.normal(0, 60, (7, 24)) * np.linspace(2, .1, 24))
    exact = q @ x.T
    for share in (.1, .4, .7):
        least = share * exact.max(axis=1)
        index = hn.Index(x, least.min(), np.sqrt((q ** 2).sum(1)).max())
        who, row, score = hn.scores_above(q, index, least)
        assert sorted(zip(who.tolist(), row.tolist(), score.tolist())) == sorted(
            (a, b, int(exact[a, b])) for a, b in zip(*(i.tolist() for i in np.nonzero(exact >= least[:, None]))))
    assert index.indexed.max() < 24 and index.indexed.min() == 0           # dimensions and vectors are omitted


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hn.mine(df, is_anchor()).count() == 0
    assert hn.mine(spark.createDataFrame([(1, 1, [1.])], "vec_id long, label int, embedding array<float>"), is_anchor()).count() == 0
    assert hn.mine(spark.createDataFrame([(100, 1, [1.])], "vec_id long, label int, embedding array<float>"), is_anchor()).count() == 0
