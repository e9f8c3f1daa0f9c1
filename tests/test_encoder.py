"""Corpus-trained encoder against NumPy's singular vectors and brute-force scores."""
import numpy as np
import pyarrow as pa
import pytest

from citegrid.operators import dense, encoder, lexical
from citegrid.plans import retrieval
from conftest import SF001

FEATURES = 512


@pytest.fixture(scope="module")
def docvecs(spark):
    rng = np.random.default_rng(2)
    topics = [[f"t{t}w{i}" for i in range(12)] for t in range(6)]
    rows = []
    for d in range(240):
        words = sorted(set(rng.choice(topics[d % 6], 7).tolist()) | {f"rare{rng.integers(0, 80)}"})
        w = rng.random(len(words)) + .1
        rows.append((f"{d:03d}", words, (w / np.sqrt((w ** 2).sum())).tolist()))
    rows += [("none", [], []), ("null", None, None), ("copy", rows[0][1], rows[0][2])]
    return spark.createDataFrame(rows, "pmid string, terms array<string>, ws array<double>").repartition(5)


def matrix(docvecs):
    rows = sorted(docvecs.collect())
    a = np.zeros((len(rows), FEATURES))
    for i, r in enumerate(rows):
        at, sign = encoder.features_of(pa.array(r["terms"] or [], pa.string()), FEATURES)
        np.add.at(a[i], at, sign * np.array(r["ws"] or [], float))
    return [r["pmid"] for r in rows], a


def test_basis_spans_the_leading_singular_vectors(docvecs):
    _, a = matrix(docvecs)
    model = encoder.train(docvecs, rank=6, features=FEATURES, steps=6)
    _, s, vt = np.linalg.svd(a)
    assert np.allclose(model.singular, s[:6], rtol=1e-3)
    assert np.allclose(model.basis.T @ model.basis, np.eye(6), atol=1e-9)
    angles = np.linalg.svd(vt[:6] @ model.basis, compute_uv=False)          # cosines between the two spaces
    assert angles.min() > 0.999


def test_vectors_equal_projection(docvecs, spark, tmp_path):
    ids, a = matrix(docvecs)
    model = encoder.train(docvecs, rank=6, features=FEATURES, steps=3)
    encoder.write(model, spark, str(tmp_path / "model"))
    back = encoder.read(spark, str(tmp_path / "model"))
    assert np.array_equal(back.basis, model.basis) and np.array_equal(back.singular, model.singular)
    got = {r["pmid"]: r["vector"] for r in encoder.encode(docvecs, back).collect()}
    z = a @ model.basis
    for i, pmid in enumerate(ids):
        if not a[i].any():
            assert got[pmid] is None
        else:
            assert np.allclose(got[pmid], z[i] / np.linalg.norm(z[i]), atol=1e-6)
    assert got["copy"] == got["000"]


def test_same_topic_is_nearer(docvecs):
    model = encoder.train(docvecs, rank=6, features=FEATURES)
    vectors = encoder.encode(docvecs, model)
    q = vectors.selectExpr("pmid as qid", "vector")
    top = dense.knn(q, vectors, 5, exclude_self=True).where("qid < 'a' and pmid < 'a'").collect()
    assert np.mean([int(r["qid"]) % 6 == int(r["pmid"]) % 6 for r in top]) > 0.95


def test_low_rank_and_empty(spark, docvecs):
    one = docvecs.where("pmid in ('000', 'copy')")
    model = encoder.train(one, rank=4, features=64)
    assert model.singular[0] == pytest.approx(2 ** .5) and (model.singular[1:] < 1e-6).all()
    empty = encoder.train(docvecs.where("false"), rank=4, features=64)
    assert (empty.singular == 0).all() and encoder.encode(docvecs.where("false"), empty).count() == 0


def test_questions_meet_their_documents(spark):
    got = retrieval.encoded_retrieval(spark, SF001, 5)
    hits = got.top.join(got.questions, "qid")
    assert got.top.groupBy("qid").count().where("count != 5").isEmpty()
    found = hits.where("pmid = relevant_pmids").select("qid").distinct().count()
    assert found / got.questions.count() > 0.3
    assert lexical.TOKEN_PATTERN


def test_parts_of_a_product_are_one_per_core(spark, docvecs, monkeypatch):
    """What is exchanged does not grow with the files of the corpus."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    parts, kept = [], Classic.mapInArrow

    def seen(self, *a, **k):
        parts.append(self.rdd.getNumPartitions())
        return kept(self, *a, **k)
    monkeypatch.setattr(Classic, "mapInArrow", seen)
    encoder.train(docvecs.repartition(40), rank=2, features=64, steps=1)
    assert parts[0] <= spark.sparkContext.defaultParallelism


def test_short_rows_are_multiplied_a_few_at_a_time():
    n = encoder.CHUNK
    batch = pa.record_batch([pa.array([[f"w{i}"] for i in range(n)], pa.list_(pa.string())), pa.array([[1.0]] * n)], ["terms", "ws"])
    sizes = [rows for _, rows, *_ in encoder._sparse(batch, FEATURES)]
    assert sum(sizes) == n and max(sizes) <= encoder.ROWS
