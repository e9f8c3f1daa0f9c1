import random
import zlib

import numpy as np
import pyarrow as pa

from citegrid.llm import toxicity as tx

BAD = ["scum", "trash", "idiot"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(10, 60))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", "."]))
        docs.append((i, " ".join(words), "x"))
        if i % 10 < 8:
            labels.append((i, 1, int(bad)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 4 == 2


def test_held_out_documents(spark):
    docs, labels = corpus(1200)
    odd = [(5000, None, "x"), (5001, "", "x"), (None, "you scum and trash", "x"), (5002, "SCUM, idiot! " * 20_000, "x"), (3, docs[3][1], "x")]
    d, lab = frames(spark, docs + odd, labels + [(3, 1, labels[3][2]), (7000, 1, 1), (None, 1, 1), (12, 1, None)])
    got = tx.score(d, lab).collect()
    assert len(got) == len(docs) + len(odd)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = {i: int(any(w.rstrip(",.") in BAD for w in t.split())) for i, t, _ in docs}
    test = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id < 1200]
    assert len(test) > 200 and np.mean([a == b for a, b in test]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[5000].predicted == by[5001].predicted == 0 and by[None].predicted == 1 and by[5002].predicted == 1
    assert by[5000].evidence == "" and by[5002].evidence
    kept = {r.doc_id for r in tx.keep_clean(d, lab).collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(300)
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    a = sorted((r.doc_id, r.score) for r in tx.score(*frames(spark, docs, labels)).collect())
    assert a == sorted((r.doc_id, r.score) for r in tx.score(*frames(spark, docs, flipped)).collect())


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    terms, n = 40, 500
    idf = rng.uniform(1, 5, terms)
    dense = np.zeros((n, terms), np.float32)
    for i in range(n):
        t = rng.choice(terms, rng.integers(1, 6), replace=False)
        dense[i, t] = idf[t] / np.sqrt((idf[t] ** 2).sum())
    blocks = -(-n // tx.BLOCK)
    weights = np.zeros((blocks, terms, tx.BLOCK), np.float32)
    for i in range(n):
        weights[i // tx.BLOCK, :, i % tx.BLOCK] = dense[i]
    e = np.zeros(0)
    index = tx.Index(np.arange(terms, dtype=np.uint64), np.zeros(0, np.uint64), idf, weights, np.ascontiguousarray(weights.max(2).T),
                     np.arange(n), e, e, 0.0, e, e)
    for i in range(100):
        t = np.sort(rng.choice(terms, rng.integers(1, 8), replace=False))
        w = index.unit(t)
        who, cos = index.nearest(t, w, 9)
        full = np.round((dense[:, t] @ w), 9)
        want = [x for x in np.lexsort((np.arange(n), -full)) if full[x] > 0][:9]
        assert np.allclose(cos, full[want], atol=1e-6) and len(who) == len(want)


def test_isotonic():
    steps, values = tx.isotonic(np.array([0., 1., 2., 3.]), np.array([0., 1., 0., 1.]), np.ones(4))
    assert steps.tolist() == [0, 1, 3] and values.tolist() == [0, .5, 1]


def test_terms_have_beginnings_and_tiers():
    rows = pa.record_batch([pa.array(["Abcdefgh abcdefgh", None])], ["text"])
    row, term = tx.terms_of(rows)
    assert set(row.tolist()) == {0} and len(np.unique(term)) == 1 + len(tx.BEGINNINGS) and len(term) == 2 * (1 + len(tx.BEGINNINGS))


def test_association_holds_at_zero_counts():
    z = tx.association(np.array([12., 34., 3., 0., 20.]), np.array([0., 5., 0., 12., 20.]), 1500, 1500)
    assert z[0] >= tx.LEAST_Z and z[1] >= tx.LEAST_Z and z[2] < tx.LEAST_Z and z[3] <= -tx.LEAST_Z and abs(z[4]) < 1e-6
    assert abs(z[0] - np.sqrt(2 * (12 * np.log(2) + 1488 * np.log(1488 / 1494) + 1500 * np.log(1500 / 1494)))) < 1e-9


def test_rare_pure_words(spark):
    rng = random.Random(5)
    marks = [c * 3 + d * 3 for c in "bcdfg" for d in "klmnp"]          # each in 4% of the toxic documents, in no clean one
    docs, labels = [], []
    for i in range(2400):
        words = [f"w{rng.randrange(300)}" for _ in range(30)]
        if i % 2:
            words.insert(rng.randrange(30), marks[i // 2 % len(marks)])
        docs.append((i, " ".join(words), "x"))
        labels.append((i, 1, i % 2))
    got = [r for r in tx.score(*frames(spark, docs, labels)).collect() if r.held_out]
    assert len(got) > 400 and sum(r.doc_id % 2 for r in got) > 200
    assert np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95
    assert np.mean([r.predicted for r in got if r.doc_id % 2]) > 0.95


def test_no_labels_and_empty(spark, empty):
    docs, _ = corpus(5)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in tx.score(spark.createDataFrame(docs, "doc_id long, text string, score string"), none).collect()} == {0.0}
    assert tx.score(empty, none).count() == 0
