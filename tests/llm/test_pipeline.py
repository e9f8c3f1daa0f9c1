"""Each stage on its own input, against plain Python or the operator's tested result."""
import random

import pytest

import corpus_pipeline
from citegrid.llm import credentials, mixing, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    root = tmp_path_factory.mktemp("corpus")
    out, labels = [], []
    for i in range(500):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(30, 90))]
        bad = i % 5 == 0
        if bad:
            words[3:3] = ["scum", "trash", "idiot"]
        if i % 7 == 3:
            words[5:5] = ["password", "=", "abcdefghijkl1234"]
        out.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(bad)))
    out += [(1000 + i, out[i][1] + " tail", "en", "s1", 0) for i in range(1, 50) if i % 5]
    out += [(2000, None, None, None, None), (2001, "", "en", "s1", 0), (None, "no id here", "en", "s1", 0)]
    out = [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s, _ in out]
    spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages(spark, folder, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "secret_scan", "source_mixing", "bin_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns = docs.columns
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, results[-1], folder).write.parquet(str(tmp_path / name))
        results.append(spark.read.parquet(str(tmp_path / name)))
        assert name == "bin_packing" or results[-1].columns == columns
    clean, single, redacted, mixed, packed = results[1:]
    bad = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert len(bad) >= 90 and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    kept = {r.doc_id for r in single.collect()}
    assert not [d for d in kept if d is not None and 1000 < d < 2000 and d - 1000 in kept]
    assert {d for d in range(500)} - bad <= kept and {2000, 2001, None} <= kept
    assert redacted.count() == single.count() and not any("abcdefghijkl1234" in (r.text or "") for r in redacted.collect())
    before = {r.doc_id: r.text for r in single.collect()}
    assert all(r.text == credentials.redact_text(before[r.doc_id]) and r.n_chars == (None if r.text is None else len(r.text)) for r in redacted.collect())
    want = {r.doc_id: r.copies for r in mixing.decide(redacted).collect() if r.copies}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want
    assert {r.doc_id for r in packed.collect()} == set(got) and packed.count() == mixed.count()


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 300


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, folder)
        assert got.count() == 0
        assert name == "bin_packing" or got.columns == docs.columns
