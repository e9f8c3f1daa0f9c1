"""Retrieval, silver questions and evaluation against independent brute force."""
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citegrid.operators import dense, evaluate, lexical, silver
from citegrid.functions import rules as R
from citegrid.functions import text as T
from citegrid.session import materialize
from citegrid.plans import retrieval
from conftest import SF001


def test_relevant_parsing(spark):
    rows = [("a", "123"), ("b", "123|456"), ("c", "123,456"), ("d", "123; 456"), ("e", " 123 456 "),
            ("f", ""), ("g", None)]
    df = spark.createDataFrame(rows, "id string, x string").select("id", evaluate.parse_relevant("x").alias("p"))
    got = {r["id"]: r["p"] for r in df.collect()}
    assert got == {"a": ["123"], "b": ["123", "456"], "c": ["123", "456"], "d": ["123", "456"],
                   "e": ["123", "456"], "f": [], "g": []}
    num = spark.createDataFrame([(123.0,), (float("nan"),), (None,)], "x double") \
        .select(evaluate.parse_relevant_numeric("x").alias("p")).collect()
    assert [r["p"] for r in num] == [["123"], [], []]


def test_hit_at_k(spark):
    cases = [(["a", "b", "c"], ["c"], 1.0), (["a", "b", "c"], ["c", "z"], 1.0),
             (["a", "b", "c"], ["z"], 0.0), (["a", "b", "c"], [], 0.0)]
    df = spark.createDataFrame([(h, r) for h, r, _ in cases], "h array<string>, r array<string>")
    got = [x[0] for x in df.select(evaluate.hit_at_k(F.col("h"), F.col("r"))).collect()]
    assert got == [c[2] for c in cases]


def _py_question(pmid, title, seed=13, p=0.30):
    toks = re.findall(r"[A-Za-z0-9\-]+", title)
    if len(toks) >= 8:
        thr = int(p * (1 << 32))
        keep = [t for i, t in enumerate(toks)
                if int(hashlib.md5(f"{seed}|{pmid}|{i}".encode()).hexdigest()[:8], 16) > thr]
        if len(keep) < 4:
            keep = toks[:6]
        return " ".join(keep)
    return title.strip()


def test_silver_questions_match_python(spark):
    arts = retrieval.articles(spark, SF001).toPandas()
    got = retrieval.silver_questions(spark, SF001, n=40).toPandas()
    arts["k"] = [hashlib.md5(f"13|{p}".encode()).hexdigest() for p in arts.pmid]
    pick = arts.sort_values(["k", "pmid"]).head(40).reset_index(drop=True)
    exp = pd.DataFrame({"qid": [f"q{i:03d}" for i in range(len(pick))],
                        "question": [_py_question(p, t) for p, t in zip(pick.pmid, pick.title)],
                        "relevant_pmids": pick.pmid})
    pd.testing.assert_frame_equal(got.sort_values("qid").reset_index(drop=True), exp)


def test_silver_rules_on_fixture(spark):
    # find ids whose dropout leaves < 4 of 8 tokens and ≥ 4, computed independently in Python
    title8 = "one two three four five six seven eight"
    few = next(str(i) for i in range(100000) if len(
        [j for j in range(8) if int(hashlib.md5(f"13|{i}|{j}".encode()).hexdigest()[:8], 16) > 0x4ccccccc]) < 4)
    rows = [("1", "Short title, kept as is."), (few, title8)]
    df = spark.createDataFrame(rows, "pmid string, title string")
    got = {r["pmid"]: r["q"] for r in df.select("pmid", silver.question_from_title(
        F.col("pmid"), F.col("title")).alias("q")).collect()}
    assert got["1"] == "Short title, kept as is."
    assert got[few] == "one two three four five six"
    with pytest.raises(ValueError):
        silver.silver_questions(df, n=5)


def _py_tfidf_top(arts: pd.DataFrame, qs: pd.DataFrame, k: int):
    tok = lambda s: [t.lower() for t in re.findall(r"[A-Za-z0-9]+", s)]
    docs = {p: Counter(tok(f"PMID: {p}\nTITLE: {t}\nABSTRACT: {a}".strip()))
            for p, t, a in zip(arts.pmid, arts.title, arts.abstract)}
    n = len(docs)
    df = Counter(t for c in docs.values() for t in c)
    idf = {t: math.log((n + 1) / (d + 1)) + 1 for t, d in df.items()}
    dvec = {}
    for p, c in docs.items():
        w = {t: f * idf[t] for t, f in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        dvec[p] = {t: v / norm for t, v in w.items()}
    out = {}
    for qid, q in zip(qs.qid, qs.question):
        c = Counter(t for t in tok(q) if t in idf)
        w = {t: f * idf[t] for t, f in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        sc = []
        for p, dv in dvec.items():
            s = sum(v / norm * dv.get(t, 0.0) for t, v in w.items())
            sc.append((-round(s, 6), p))
        out[qid] = [p for _, p in sorted(sc)[:k]]
    return out


def test_lexical_topk_matches_brute_force(spark):
    r = retrieval.lexical_retrieval(spark, SF001, k=5, n_questions=60)
    got = r.top.toPandas()
    exp = _py_tfidf_top(r.articles.toPandas(), r.questions.toPandas(), 5)
    for qid, grp in got.groupby("qid"):
        g = grp.sort_values("rank")
        assert list(g["rank"]) == list(range(1, len(g) + 1))
        assert list(g.pmid) == exp[qid], qid


def test_dense_tilings_agree_with_numpy(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    d = e.select(F.col("vec_id").alias("neighbor"), F.col("embedding").alias("vector"))
    out = {}
    for tile in (64, 4096):
        top = dense.knn(q, d, 5, qid="qid", did="neighbor", exclude_self=True, tile_rows=tile).toPandas()
        out[tile] = {qid: list(g.sort_values("rank").neighbor) for qid, g in top.groupby("qid")}
    pdf = e.toPandas()
    M = np.stack(pdf.embedding.map(lambda v: np.asarray(v, dtype=np.float32))).astype(np.float64)
    ids = pdf.vec_id.to_numpy()
    S = np.round(M @ M.T, 6)
    np.fill_diagonal(S, -np.inf)
    exp = {}
    for i, qid in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda j: (-S[i, j], ids[j]))[:5]
        exp[qid] = [ids[j] for j in order]
    assert out[64] == exp and out[4096] == exp


def test_odd_vectors_go_to_rejects_in_every_tiling(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, None), (4, [1.0, 0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = [sorted((r["qid"], r["neighbor"], r["score"]) for r in dense.knn(
        df.select(F.col("id").alias("qid"), "vector"), df.select(F.col("id").alias("neighbor"), "vector"), 2, did="neighbor",
        exclude_self=True, tile_rows=t).collect()) for t in (1, 100)]
    assert got[0] == got[1] and {q for q, _, _ in got[0]} == {1, 2, 7}
    rejects = {r["id"]: r["reason"] for r in dense.vector_rejects(df, "id", "vector", dense.dimension(df, "vector")).collect()}
    assert rejects == {3: "null vector", 4: "other length", 5: "null or non-finite component", 6: "null or non-finite component"}


def test_ties_need_k_rows_only():
    from citegrid.operators.topk import BestSoFar
    best = BestSoFar(5)
    for lo in range(0, 100_000, 20_000):
        best.add(np.ones((2, 20_000)), np.array([f"{i:06d}" for i in range(lo, lo + 20_000)], dtype=object))
        assert len(best.q) == 10
    assert list(best.d[:5]) == [f"{i:06d}" for i in range(5)]
    sparse = np.full((50, 4000), -np.inf)
    sparse[:, 7] = 0.5
    few = BestSoFar(5)
    few.add(sparse, np.arange(4000))
    assert len(few.q) == 50


def test_top_k_plan_limits_before_shuffle(spark):
    found = lexical.search(retrieval.silver_questions(spark, SF001, n=20), *retrieval.lexical_index(spark, SF001), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "MapInArrow" in plan or "PythonMapInArrow" in plan   # block scorer: no pair-level shuffle


def test_question_tiles_agree(spark):
    arts = retrieval.articles(spark, SF001)
    docvecs, vocab = lexical.build_doc_vectors(arts)
    docvecs, vocab = materialize(docvecs, "t-docvecs"), materialize(vocab, "t-vocab")
    qs = retrieval.silver_questions(spark, SF001, n=40)
    key = lambda t: sorted(tuple(r) for r in lexical.search(qs, docvecs, vocab, 5, tile_questions=t).select("qid", "rank", "pmid", "score").collect())
    assert key(7) == key(4096)


def test_tiles_beyond_one_stay_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    from citegrid.operators import tiles
    docvecs, vocab = retrieval.lexical_index(spark, SF001)
    qs = retrieval.silver_questions(spark, SF001, n=60)
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    d = e.select(F.col("vec_id").alias("neighbor"), F.col("embedding").alias("vector"))
    monkeypatch.setattr(tiles, "BLOCK_ROWS", 64)
    one = [sorted(map(tuple, x.collect())) for x in (lexical.search(qs, docvecs, vocab, 5), dense.knn(q, d, 5, did="neighbor", exclude_self=True))]

    def never(*a, **k):
        raise AssertionError("the query side went to the driver")
    for name in ("toPandas", "toArrow"):
        monkeypatch.setattr(Classic, name, never)
    sizes, out = [], []
    for t in (30, 10):
        found = lexical.search(qs, docvecs, vocab, 5, tile_questions=t), dense.knn(q, d, 5, did="neighbor", exclude_self=True, tile_rows=t * 4)
        sizes.append([x._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow") for x in found])
        out.append([sorted(map(tuple, x.collect())) for x in found])
    assert out[0] == out[1] == one
    assert sizes == [[1, 1], [1, 1]]                        # one plan whatever the number of tiles


def test_terms_of_every_document_weigh_alike(spark):
    text = " ".join(f"w{i:04d}" for i in range(lexical.EVERYWHERE + 500))
    arts = spark.createDataFrame([(str(i), "", text) for i in range(4)], "pmid string, title string, abstract string")
    docvecs, vocab = lexical.build_doc_vectors(arts)
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    assert all(idf[t] == 1.0 for t in text.split())
    for r in docvecs.collect():
        assert len({w for t, w in zip(r["terms"], r["ws"]) if t.startswith("w0")}) == 1


def test_unicode_white_space(spark):
    df = spark.createDataFrame([("\u2003a\u00a0b\u2028c\x85 ",)], "t string")
    assert df.select(T.collapse_ws("t").alias("x")).first()["x"] == "a b c"
    long = "word " * 40 + "\u2028" + "tail " * 100
    assert 500 < len(spark.createDataFrame([(long,)], "t string").select(T.snippet_words("t").alias("x")).first()["x"]) <= 550
    cited = spark.createDataFrame([("One.\u00a0Two [1].",)], "t string").select(R.each_sentence_cited("t").alias("x")).first()["x"]
    assert cited is False


def test_exchange_of_tiles_grows_with_the_input():
    """Rows copied to groups, as multiples of the two sides: small tiles cost no more than large ones."""
    from citegrid.operators import tiles
    for asked, docs in ((650_000, 650_000), (6_500_000, 6_500_000), (39_000_000, 39_000_000), (2_700_000, 115_000_000)):
        strips, blocks = tiles.grid(asked, docs, 48)
        assert strips * blocks >= 48
        assert asked / strips <= tiles.SIDE_NUMBERS and docs / blocks <= tiles.SIDE_NUMBERS
        assert strips * docs + blocks * asked <= 16 * (asked + docs)          # tiles of 128 rows of 64 numbers: 80 to 4,762 times


def test_small_tiles_copy_documents_no_more_often(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    d = e.select(F.col("vec_id").alias("neighbor"), F.col("embedding").alias("vector"))
    plans = [dense.knn(q, d, 5, did="neighbor", exclude_self=True, tile_rows=t)._jdf.queryExecution().optimizedPlan().toString() for t in (1, 40)]
    copies = [re.findall(r"pmod\(xxhash64\([^)]*\), (\d+)\)", p) for p in plans]
    assert copies[0] == copies[1] and copies[0]


def test_kth_score_rules_out_the_rest():
    from citegrid.operators.topk import BestSoFar
    rng = np.random.default_rng(5)
    scores = np.round(rng.random((30, 5000)), 3)                              # many ties
    ids = rng.permutation(5000)
    best = BestSoFar(5)
    for lo in range(0, 5000, 250):
        best.add(scores[:, lo:lo + 250], ids[lo:lo + 250])
    for i in range(30):
        want = sorted(zip(-scores[i], ids))[:5]
        assert [(-s, d) for s, d in zip(best.s[best.q == i], best.d[best.q == i])] == want


def test_dense_and_sparse_terms_give_one_product():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    words = [f"t{i}" for i in range(300)]
    rare = 1 / np.arange(1, 301)

    def lists(n, size):
        out = [sorted(set(rng.choice(words, size, p=rare / rare.sum()).tolist())) for _ in range(n)]
        return out, [rng.random(len(x)).tolist() for x in out]
    qt, qw = lists(40, 12)
    dt, dw = lists(500, 40)
    exp = np.array([[sum(w * dict(zip(b, v)).get(t, 0.0) for t, w in zip(a, u)) for b, v in zip(dt, dw)] for a, u in zip(qt, qw)])
    asked = pa.table({"qid": [f"q{i:02d}" for i in range(40)], "terms": qt, "ws": qw})
    docs = pa.table({"terms": dt, "ws": dw}).to_batches(max_chunksize=64)
    parts = [(np.arange(i * 64, i * 64 + len(rb)), rb) for i, rb in enumerate(docs)]
    for most in (0, 8, 1024):
        lexical.DENSE_TERMS, kept = most, lexical.DENSE_TERMS
        found = list(lexical.Tiles.of_lists(asked, 7).best(iter(parts), 5))
        lexical.DENSE_TERMS = kept
        for qids, ids, scores in found:
            for q in set(qids):
                got = [(d, s) for p, d, s in zip(qids, ids, scores) if p == q]
                row = exp[int(q[1:])]
                want = sorted(range(500), key=lambda j: (-round(row[j], 6), j))[:5]
                assert [d for d, _ in got] == want and np.allclose([s for _, s in got], np.round(row[want], 6), atol=2e-6)


def test_postings_do_not_travel_as_rows(spark, monkeypatch):
    """One row a document meets its shard's terms; a shard cut in two counts right."""
    text = [" ".join(f"w{j}" for j in range(i % 7, 40)) for i in range(60)]
    arts = spark.createDataFrame([(str(i), "", t) for i, t in enumerate(text)], "pmid string, title string, abstract string").repartition(3)
    monkeypatch.setattr(lexical, "SHARD_DOCS", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    kept = {}
    try:
        docvecs, vocab = lexical.build_doc_vectors(arts, keep=lambda df, name: kept.setdefault(name, materialize(df, name)))
        rows, idf = docvecs.collect(), {r["term"]: r["idf"] for r in vocab.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = Counter(t for x in text for t in set(x.split()))
    assert all(math.isclose(idf[t], math.log(61 / (n + 1)) + 1) for t, n in df.items())
    assert len(rows) == 60 and all(math.isclose(sum(w * w for w in r["ws"]), 1) and all(
        math.isclose(w / r["ws"][r["terms"].index("pmid")], idf[t] / idf["pmid"]) for t, w in zip(r["terms"], r["ws"]) if t[0] == "w") for r in rows)
    assert "pmid" not in kept["index-shard-terms"].columns
    plan = docvecs._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Generate" not in plan


def test_few_questions_do_not_widen_a_block(monkeypatch):
    """A batch of many documents is looked up and scored in bounded parts."""
    import pyarrow as pa
    seen, kept = [], lexical._scores
    monkeypatch.setattr(lexical, "_scores", lambda tile, n, *a: seen.append(n) or kept(tile, n, *a))
    n = 3 * lexical.SCORED_DOCS + 5
    docs = pa.RecordBatch.from_pydict({"terms": [["a", f"b{i}"] for i in range(n)], "ws": [[1.0, i / n] for i in range(n)]})
    asked = pa.table({"qid": ["q"], "terms": [["a", f"b{n - 1}"]], "ws": [[0.5, 0.5]]})
    (qids, ids, scores), = lexical.Tiles.of_lists(asked).best(iter([(np.arange(n), docs)]), 2)
    assert sum(seen) == n and max(seen) <= lexical.SCORED_DOCS
    assert list(ids) == [n - 1, 0] and list(scores) == [round(0.5 + 0.5 * (n - 1) / n, 6), 0.5]


def test_words_are_counted_a_few_documents_at_a_time():
    import pyarrow as pa
    n = 2 * lexical.COUNTED_DOCS + 3
    batch = pa.RecordBatch.from_pydict({"pmid": [str(i) for i in range(n)], "words": [["b", "a", "b"]] * n})
    out = list(lexical._count_words(iter([batch])))
    assert [rb.num_rows for rb in out] == [lexical.COUNTED_DOCS, lexical.COUNTED_DOCS, 3]
    assert all(r == ["a", "b"] for rb in out for r in rb.column("terms").to_pylist()) and out[0].column("tfs")[0].as_py() == [1, 2]


def test_strips_in_turns_agree_and_hold_one_turn(spark, monkeypatch, tmp_path):
    """Where strips take turns, results are the same, and what travels at a time follows the documents, not strips times documents."""
    from citegrid.operators import tiles
    for asked, docs in ((18_000_000, 876_000_000), (180_000_000, 8_760_000_000)):
        strips, blocks = tiles.grid(asked, docs, 48)
        took = tiles.turns(asked, docs, strips, blocks)
        assert [s for now in took for s in now] == list(range(strips))
        assert max(len(now) for now in took) * (docs + blocks * asked // strips) <= max(tiles.TURN_NUMBERS, 3 * docs)
    docvecs, vocab = retrieval.lexical_index(spark, SF001)
    qs = retrieval.silver_questions(spark, SF001, n=60)
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    d = e.select(F.col("vec_id").alias("neighbor"), F.col("embedding").alias("vector"))
    search = lambda: [sorted(map(tuple, x.collect())) for x in (lexical.search(qs, docvecs, vocab, 5, tile_questions=10),
                                                                  dense.knn(q, d, 5, did="neighbor", exclude_self=True, tile_rows=20))]
    one, written = search(), []
    monkeypatch.setattr(tiles, "SIDE_NUMBERS", 2000)
    monkeypatch.setattr(tiles, "TURN_NUMBERS", 1)

    def keep(df, name, **kw):
        written.append(materialize(df, name, **kw))
        return written[-1]
    monkeypatch.setattr(tiles, "materialize", keep)
    assert search() == one
    assert len(written) > 2 and all(n <= 5 for w in written for n in [r["count"] for r in w.groupBy("qid").count().collect()])


def test_a_write_frees_its_shuffle_files(spark):
    import os
    import time
    from citegrid.session import materialize as write
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {f for d in disk.localDirsString() for _, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}
    before = held()
    write(spark.range(2000).repartition(7, "id"), "t-kept")
    kept = held() - before
    out = write(spark.range(2000).repartition(7, "id"), "t-freed", free=True)
    end = time.time() + 20
    while held() - before - kept and time.time() < end:                       # Spark deletes in the background
        time.sleep(0.1)
    assert kept and not held() - before - kept
    assert out.count() == 2000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
