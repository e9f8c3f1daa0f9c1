"""Jobs end to end: ingest (L1), answer with generator/retries/fallback (L3),
evaluate with sinks (L4), encoder slot, sinks."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citegrid.functions import vectors as V
from citegrid.operators import answers as A
from citegrid.operators import dense, lexical
from citegrid.plans import jobs, retrieval
from citegrid.session import materialize
from citegrid.sources import cascade, corpus, markup
from conftest import SF001

XML = """<?xml version="1.0"?>
<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">11</PMID><Article><ArticleTitle>The <i>BRCA1</i> gene &amp; co</ArticleTitle>
<Abstract><AbstractText Label="BACKGROUND">Line one.</AbstractText><AbstractText>Two x <sub></sub>end.</AbstractText></Abstract></Article></MedlineCitation>
<PubmedData><ReferenceList><Reference><ArticleIdList><PMID>99</PMID></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>12</PMID><Article><ArticleTitle>No abstract</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>13</PMID><Article><ArticleTitle></ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>14</PMID><Article><ArticleTitle>Broken <b>tag</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><Article><ArticleTitle>No id here</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>11</PMID><Article><ArticleTitle>Duplicate of eleven</ArticleTitle></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>
"""

GOOD = ("Answer:\nThe evidence is summarised here [1].\nBiomarkers mentioned in Evidence:\n- None [1]\n"
        "Takeaways:\n- a [1]\n- b [1]\n- c [1]")


def test_ingest_job(spark, tmp_path):
    p = tmp_path / "set.xml"
    p.write_text(XML)
    levels = [cascade.Level("nothing[Title/Abstract]", cascade.tiab("zzzz")),
              cascade.Level("gene[Title/Abstract] OR abstract[Title/Abstract]",
                            cascade.tiab("gene") | cascade.tiab("abstract") | cascade.tiab("duplicate"))]
    res = jobs.ingest(spark, str(p), levels, n_docs=10, out_dir=str(tmp_path / "out"))
    got = {r["pmid"]: (r["title"], r["abstract"]) for r in res.articles.collect()}
    assert got == {"11": ("The BRCA1 gene & co", "Line one. Two x end."), "12": ("No abstract", "")}
    assert res.query_used.startswith("gene")
    assert res.meta.first()["saved_n_docs"] == 2
    assert res.rejects.count() == 3            # malformed, no id, no text
    back = corpus.read_articles_csv(spark, str(tmp_path / "out" / "corpus_csv"))
    assert back.count() == 2


def test_cascade_no_match_raises(spark):
    arts = spark.createDataFrame([("1", "a", "b")], "pmid string, title string, abstract string")
    try:
        cascade.search(arts, [cascade.Level("x", cascade.tiab("zzz"))], 5)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_dedup_hot_key(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "pmid string, pos long, title string")
    out = markup.dedup_keep_first(df, "pmid", ["pos"])
    assert out.count() == 2001
    assert out.where("pmid = 'hot'").first()["pos"] == 0


def _index(spark):
    arts = retrieval.articles(spark, SF001)
    docvecs, vocab = lexical.build_doc_vectors(arts)
    return arts, materialize(docvecs, "test-docvecs"), materialize(vocab, "test-vocab")


def test_answer_job_composer_is_always_valid(spark, tmp_path):
    arts, postings, vocab = _index(spark)
    qs = retrieval.silver_questions(spark, SF001, n=20)
    rec = jobs.answer(qs, arts, postings, vocab, k=6, out_path=str(tmp_path / "answers"))
    rows = rec.collect()
    assert len(rows) == 20
    assert all(r["validation"]["ok"] for r in rows), [r["validation"]["issues"] for r in rows if not r["validation"]["ok"]]
    assert all(len(r["retrieval"]) <= 6 for r in rows)


def test_answer_job_retries_then_fallback(spark):
    arts, postings, vocab = _index(spark)
    qs = retrieval.silver_questions(spark, SF001, n=8)

    def fixed_on_retry(pdf: pd.DataFrame) -> pd.Series:
        return pd.Series(["References:\nnope" if a == 0 else GOOD for a in pdf["attempt"]])

    rec = jobs.answer(qs, arts, postings, vocab, k=5, generator=fixed_on_retry, max_retries=2).collect()
    assert all(r["validation"]["ok"] and r["retries_used"] == 1 and not r["used_fallback"] for r in rec)

    def always_bad(pdf: pd.DataFrame) -> pd.Series:
        return pd.Series(["not relevant"] * len(pdf))

    rec = jobs.answer(qs, arts, postings, vocab, k=5, generator=always_bad, max_retries=2).collect()
    assert all(r["used_fallback"] and r["retries_used"] == 2 and r["validation"]["ok"] for r in rec)

    def broken(pdf: pd.DataFrame) -> pd.Series:
        raise RuntimeError("model down")

    rec = jobs.answer(qs, arts, postings, vocab, k=5, generator=broken, max_retries=1).collect()
    assert all(r["used_fallback"] and r["validation"]["ok"] for r in rec)


def test_evaluate_job_sinks(spark, tmp_path):
    arts, postings, vocab = _index(spark)
    csv = str(tmp_path / "eval_questions")
    res = jobs.evaluate(spark, arts, postings, vocab, k=5, eval_csv=csv, n_questions=30, run_llm=True,
                        out_dir=str(tmp_path / "eval"))
    m = res.metrics.first()
    assert m["n_questions"] == 30 and 0.0 <= m["recall_at_k"] <= 1.0
    assert m["citations_present_rate"] == 1.0 and m["citations_valid_rate"] == 1.0
    # build-if-missing leaves an existing question file alone
    before = sorted(r["qid"] for r in corpus.read_questions_csv(spark, csv).collect())
    jobs.evaluate(spark, arts, postings, vocab, k=5, eval_csv=csv, n_questions=10)
    assert sorted(r["qid"] for r in corpus.read_questions_csv(spark, csv).collect()) == before
    off = jobs.evaluate(spark, arts, postings, vocab, k=5, n_questions=10).metrics.first()
    assert off["citations_present_rate"] is None and off["llm"] is None
    assert spark.read.json(str(tmp_path / "eval" / "eval_runs")).count() == 30


def test_encoder_slot_and_dense_index(spark, tmp_path):
    dim = 16

    def make():
        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                for w in str(t).lower().split():
                    out[i, hash(w) % dim] += 1.0
            return out
        return predict

    enc = V.encoder_udf(make, dim, batch_size=64)
    arts = retrieval.articles(spark, SF001).limit(50)
    docs = arts.select("pmid", enc(F.col("title")).alias("vector"))
    from citegrid.plans import index
    idx = index.write_dense_index(docs, str(tmp_path / "dense"))
    norms = idx.select(V.l2_norm("vector").alias("n")).where("n > 0").collect()
    assert all(abs(r["n"] - 1.0) < 1e-5 for r in norms)
    q = idx.select(F.col("pmid").alias("qid"), "vector")
    top = dense.knn(q, idx, 3, qid="qid", did="pmid").collect()
    assert len(top) > 0


def test_page_flattening(spark):
    html = ('<html><head><title>A &amp; <b>B</b></title><style>p{x}</style>'
            '<script>var t="</p>";</script></head><body><nav>menu</nav><!-- c --><article><h1>A &amp; B</h1>'
            '<p><b>First</b> para.<br><p>Second &lt;x&gt; para.</p></article><footer>f</footer></body></html>')
    df = spark.createDataFrame([(1, "https://h.example.org/en/42?x=1", html),
                                (2, "https://other.example.net/en/42.html", "<title></title>"),
                                (3, "https://h.example.org/about", "<title>t</title>")],
                               "page_id long, url string, html string")
    flat = {r["page_id"]: r for r in markup.flatten_pages(df).collect()}
    assert (flat[1]["pmid"], flat[1]["title"], flat[1]["abstract"]) == ("en/42", "A & B", "First para. Second <x> para.")
    assert flat[3]["pmid"] is None
    kept = markup.keep_nonempty(markup.flatten_pages(df))
    assert sorted(r["page_id"] for r in kept.collect()) == [1]


def test_ingest_keeps_the_first_record(spark, tmp_path):
    """A larger second file, which Spark reads first, doesn't win."""
    rec = "<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>{}</ArticleTitle></Article></MedlineCitation></PubmedArticle>"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(rec.format("gene FIRST"))
    (tmp_path / "in" / "b.xml").write_text(rec.format("gene SECOND") + "".join(rec.replace("7", str(100 + i)).format("gene x") for i in range(300)))
    res = jobs.ingest(spark, str(tmp_path / "in"), [cascade.Level("gene", cascade.tiab("gene"))], n_docs=1000)
    assert res.articles.where("pmid = '7'").first()["title"] == "gene FIRST" and res.articles.count() == 301


def test_limit_counts_articles_not_rows(spark):
    arts = spark.createDataFrame([(i, "gene", "") for i in ("1", "1", "2", "3")], "pmid string, title string, abstract string")
    levels = [cascade.Level("gene", cascade.tiab("gene"))]
    assert [r["pmid"] for r in cascade.search(arts, levels, 2)[0].collect()] == ["1", "2"]
    placed = arts.withColumn("at", -F.col("pmid").cast("int"))
    assert [r["pmid"] for r in cascade.search(placed, levels, 2, order=["at"])[0].collect()] == ["3", "2"]


def test_phrase_stays_inside_a_field(spark):
    arts = spark.createDataFrame([("1", "on the breast", "cancer is"), ("2", "x", "of breast cancer")], "pmid string, title string, abstract string")
    hit = cascade.with_haystack(arts).where(cascade.tiab("breast cancer")).collect()
    assert [r["pmid"] for r in hit] == ["2"]


def test_existing_question_file_needs_no_corpus(spark, tmp_path):
    arts = retrieval.articles(spark, SF001)
    path = str(tmp_path / "q")
    first = jobs.question_file(spark, arts, path, n_questions=10).count()
    assert first == 10 and jobs.question_file(spark, arts.limit(3), path, n_questions=10).count() == 10


def test_one_failing_prompt_loses_one_answer(spark):
    prompts = spark.createDataFrame([(f"q{i}", f"p{i}") for i in range(20)], "qid string, prompt string").coalesce(1)

    def generator(pdf, client):
        assert (pdf["temperature"] == 0.5).all() and client == "client"
        if (pdf["prompt"] == "p7").any():
            raise RuntimeError("x" * 600)
        return pdf["prompt"] + " ok"

    got = A.generate(prompts, generator, options=A.GenerationOptions(temperature=0.5), make_client=lambda: "client").collect()
    bad = [r for r in got if r["gen_error"]]
    assert len(got) == 20 and [r["qid"] for r in bad] == ["q7"] and "x" * 600 in bad[0]["gen_error"]
    assert all(r["raw_answer"].endswith(" ok") for r in got if r["qid"] != "q7")


def test_a_stuck_call_times_out(spark):
    import time
    prompts = spark.createDataFrame([("a", "slow"), ("b", "quick")], "qid string, prompt string").coalesce(1)

    def generator(pdf):
        time.sleep(3 if pdf["prompt"][0] == "slow" else 0)
        return pdf["prompt"]

    got = {r["qid"]: r for r in A.generate(prompts, generator, options=A.GenerationOptions(timeout_s=0.5)).collect()}
    assert "Timeout" in got["a"]["gen_error"] and got["b"]["raw_answer"] == "quick"


def test_doc_store_reads_the_buckets_of_its_ids(spark):
    """Rows that the scan reads for some spread ids stay far under the table."""
    from citegrid.plans import index
    old, index.BUCKET_ROWS = index.BUCKET_ROWS, 100
    try:
        arts = spark.range(50_000).select(F.col("id").cast("string").alias("pmid"), F.lit("t").alias("title"), F.lit("a").alias("abstract"))
        store = index.doc_store(spark, lambda: arts, [f"{SF001}/region.parquet"], name="lookup-test")
        ids = spark.createDataFrame([(str(i * 997 % 50_000),) for i in range(40)], "pmid string")
        found = index.lookup(store, ids)
        assert found.count() <= 40 * 250
        assert found.join(ids, "pmid").count() == 40
    finally:
        index.BUCKET_ROWS = old


def test_retrieval_job_on_a_doc_store(spark):
    arts, docvecs, vocab = _index(spark)
    store = retrieval.doc_store(spark, SF001)
    qs = retrieval.silver_questions(spark, SF001, n=10).unionByName(
        spark.createDataFrame([("q-none", "zzzzqqq xxyyzz", "")], "qid string, question string, relevant_pmids string"))
    got = {r["qid"]: [h["pmid"] for h in r["hits"]] for r in jobs.retrieve(qs, store, docvecs, vocab, 5).collect()}
    assert len(got) == 11 and all(len(h) == 5 for h in got.values())
    assert got["q-none"] == sorted(r["pmid"] for r in arts.collect())[:5]      # filled up with the smallest ids


def test_runs_of_a_text_hold_the_same_tokens(spark):
    """Validation on the distinct runs of the evidence finds what it finds on the evidence."""
    from citegrid.functions import markers as M
    texts = ["BRCA1-low are AR. Text\nHER-2/neu, x\u212aB7 \u0130AB", "", None, "---AB--CD EF9", "ab-cd\tefg " * 50]
    answer = "BRCA1 AR HER-2 NEU KB7 IAB CD--E AB--CD EF9 B-CD FG9 GA QQ7 XKB7"
    df = spark.createDataFrame([(t, answer) for t in texts], "t string, a string").select(
        "t", M.token_runs("t").alias("runs"), M.leaked_tokens("a", "t").alias("x"), M.leaked_tokens("a", M.token_runs("t")).alias("y"))
    rows = df.collect()
    assert all(r["x"] == r["y"] for r in rows) and any(r["x"] != rows[1]["x"] for r in rows)
    assert len(rows[-1]["runs"]) == 9


def test_rounds_read_no_texts_of_hits(spark, monkeypatch):
    from citegrid.operators import answers as A
    from citegrid.operators import evidence as EV
    from citegrid.session import materialize
    text = "Known AB12 words " * 3000
    hits = [(1, "1", "Title", text, 1.0)]
    qs = spark.createDataFrame([(f"q{i}", "what", hits) for i in range(3)],
                               "qid string, question string, hits array<struct<rank:int,pmid:string,title:string,abstract:string,score:double>>")
    ctx, kept = EV.with_evidence(qs, 1, "strict"), {}
    monkeypatch.setattr(A, "materialize", lambda df, name: kept.setdefault(name, materialize(df, name)))
    ready = spark.createDataFrame([(f"q{i}", a, f"Answer:\nZZ99{i} [1].") for i in range(3) for a in range(2)], "qid string, attempt int, raw_answer string")
    out = A.answer_questions(ctx, ready, 1, max_retries=1).collect()
    assert all(r["used_fallback"] and r["validation"]["ok"] and r["evidence"].endswith(text) for r in out)
    assert max(len(r["evidence"]) for r in kept["answers-seen"].collect()) < 100


def test_facts_of_documents_tell_what_their_texts_tell(spark):
    """Markers, blocks, prompt and leaked tokens from facts of the documents are those from the texts of the hits."""
    from citegrid.functions import markers as M
    from citegrid.operators import evidence as EV
    from citegrid.operators import topk
    many = " ".join(f"Q{i:03d}" for i in range(80))
    texts = [("1", "BRCA1 leads", "are AR-low. " + "Text " * 400), ("2", None, "HER-2/neu, xKB7 İAB brca1x"), ("3", "ends in AB", "12 starts"),
             ("4", "---AB--CD EF9", None), ("5", "ÉAB1 AB1É AR", many), ("6", "", "")]
    docs = spark.createDataFrame(texts, "pmid string, title string, abstract string")
    top = spark.createDataFrame([("a", "1", 0.9, 1), ("a", "2", 0.8, 2), ("a", "3", 0.8, 3), ("b", "5", 0.7, 1), ("b", "1", 0.6, 2), ("b", "4", 0.1, 3),
                                 ("c", "6", 0.0, 1), ("d", "2", 0.5, 1), ("d", "2", 0.5, 6)], "qid string, pmid string, score double, rank int")
    said = "BRCA1 AR HER-2 NEU KB7 IAB CD--E AB--CD EF9 AB12 AB\n12 Q079 Q07 QQ7 AB1 DNA"
    qs = spark.createDataFrame([(q, f"what {q}", said) for q in "abcdea"], "qid string, question string, answer string")     # e has no hits, a comes twice
    old = EV.with_evidence(topk.with_hits(qs, topk.hit_arrays(topk.hits_with_docs(top, docs))), 5, "strict").withColumn("leaked", M.leaked_tokens("answer", "evidence"))
    facts = EV.document_facts(top, docs)
    new = EV.with_evidence(topk.with_hits(qs, EV.hit_facts(top, facts, 5)), 5, "strict").withColumn("pmids", F.transform("hits", lambda h: h["pmid"]))
    cols = ["qid", "markers", "mblocks", "context", "prompt"]
    key = lambda df, *c: sorted(df.select(*c).collect(), key=str)
    assert key(old, *cols, "leaked") == key(EV.with_leaked(new, facts), *cols, "leaked")
    assert [r["leaked"] for r in EV.with_leaked(new, facts, where=F.col("qid") == "b").collect() if r["qid"] != "b"] == [[]] * 5
    assert facts.count() == 6


def test_many_questions_move_no_text_of_a_document(spark, tmp_path, monkeypatch):
    """What the conversation queries write follows the documents and the questions, not the questions times the texts of their hits."""
    from citegrid.operators import evidence as EV
    from citegrid.plans import catalog
    n, text = 40, ["Word AB12. " + " ".join(f"w{d}x{i}" for i in range(4000)) for d in range(6)]
    spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in enumerate(text)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(c, t, role, said) for c in range(n) for t, role, said in ((0, "user", f"word w{c % 6}x{c} ?"), (1, "assistant", f"Answer:\nAB12 and W{c % 6}X{c} and ZZ9 [1]."))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    written = []

    def keep(df, name, *a, **kw):
        out = materialize(df, name, *a, **kw)
        written.append(out.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0)
        return out
    for module in (catalog, A, EV):
        monkeypatch.setattr(module, "materialize", keep, raising=False)
    told = {r["qid"]: r for r in catalog.q_validate_conversations(spark, str(tmp_path)).collect()}
    assert len(told) == n and all(r["leaked_tokens"] == "ZZ9" for r in told.values())
    assert len(catalog.q_answer_retries(spark, str(tmp_path)).collect()) == n
    assert written and max(written) < 2 * sum(map(len, text))
