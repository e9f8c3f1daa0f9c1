"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or data Spark derives from them) in
full.  Array results are flattened to strings (``array_join``) so that the
cross-engine value check compares plain columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.functions import compose as C
from citegrid.functions import markers as M
from citegrid.functions import rules as R
from citegrid.functions import text as T
from citegrid.functions import vectors as V
from citegrid.operators import answers as A
from citegrid.operators import evaluate as E
from citegrid.operators import evidence as EV
from citegrid.operators import dense, lexical, topk
from citegrid.plans import index, jobs, retrieval
from citegrid.session import materialize, scratch_path
from citegrid.sources import cascade, corpus, markup, querytext

K = 5
SEP = " || "


def _fmt(c: Column) -> Column:
    return F.format_string("%.6f", c)


def _ints(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ",")


# ---------------------------------------------------------------- retrieval

def q_doc_text(spark, sf):
    a = retrieval.articles(spark, sf)
    return a.select("pmid", T.doc_text("pmid", "title", "abstract").alias("doc_text"))


def q_l2_normalize(spark, sf):
    e = corpus.table(spark, sf, "embeddings")
    n = V.l2_normalize("embedding")
    return e.select("vec_id", F.round(V.l2_norm("embedding"), 6).alias("norm_in"),
                    F.round(V.l2_norm(n), 6).alias("norm_out"),
                    F.array_join(F.transform(n, _fmt), ",").alias("vec"))


def q_lexical_vectors(spark, sf):
    """The written index of the corpus (built on first use, tokenising
    the corpus once), in postings form."""
    docvecs, _ = retrieval.lexical_index(spark, sf)
    return lexical.to_postings(docvecs).select("pmid", "term", F.round("w", 6).alias("w"))


def _dense(spark, sf, **kw):
    e = corpus.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("qid"), F.col("vec_id").alias("neighbor"), F.col("embedding").alias("vector"))
    top = dense.knn(e.select("qid", "vector"), e.select("neighbor", "vector"), K, qid="qid", did="neighbor",
                    exclude_self=True, **kw)
    return top.select("qid", F.col("rank").cast("int").alias("rank"), "neighbor", "score")


def q_knn_dense(spark, sf):
    """Every vector's 5 nearest other vectors."""
    return _dense(spark, sf)


def q_knn_dense_block(spark, sf):
    """The same by many small query tiles."""
    return _dense(spark, sf, tile_rows=128)


def q_dense_hit_at_k(spark, sf):
    """A2 on the dense index: a vector's top-5 counts as a hit when it holds a
    neighbour with the same label."""
    e = corpus.table(spark, sf, "embeddings")
    top = _dense(spark, sf)
    lab = e.select(F.col("vec_id").alias("neighbor"), F.col("label").alias("n_label"))
    q = e.select(F.col("vec_id").alias("qid"), F.col("label").alias("q_label"))
    # both sides grow with the table (N*k hits, N labels): plain equi-joins,
    # AQE picks broadcast only from measured sizes
    j = top.join(lab, "neighbor").join(q, "qid")
    return j.groupBy("qid").agg(F.max((F.col("n_label") == F.col("q_label")).cast("double")).alias("hit"))


def q_knn_lexical(spark, sf):
    r = retrieval.lexical_retrieval(spark, sf, K)
    return r.top.select("qid", F.col("rank").cast("int").alias("rank"), "pmid", "score")


def q_encode_documents(spark, sf):
    """Every document in the space of the encoder trained on the corpus."""
    v = retrieval.encoded_documents(spark, sf)
    return v.select("pmid", F.round(V.l2_norm("vector"), 4).alias("norm"),
                    F.array_join(F.transform("vector", _fmt), ",").alias("vec"))


def q_knn_encoded(spark, sf):
    """R1 on encoded questions and documents."""
    r = retrieval.encoded_retrieval(spark, sf, K)
    return r.top.select("qid", F.col("rank").cast("int").alias("rank"), "pmid", F.round("score", 4).alias("score"))


def q_encoded_hit_at_k(spark, sf):
    """A2 on the encoded retrieval."""
    r = retrieval.encoded_retrieval(spark, sf, K)
    return E.eval_rows(r.questions, r.hit_arrays, K).select("qid", "recall_at_k")


def q_hits_with_docs(spark, sf):
    return retrieval.lexical_retrieval(spark, sf, K).hits


def q_silver_questions(spark, sf):
    return retrieval.silver_questions(spark, sf)


def q_hit_at_k(spark, sf):
    r = retrieval.lexical_retrieval(spark, sf, K)
    return E.eval_rows(r.questions, r.hit_arrays, K).select("qid", "recall_at_k")


# ----------------------------------------------------------------- evidence

def _ctx(spark, sf, style="strict"):
    r = retrieval.lexical_retrieval(spark, sf, K)
    return EV.with_evidence(topk.with_hits(r.questions, r.hit_arrays), K, style)


def q_evidence_text(spark, sf):
    return _ctx(spark, sf).select("qid", "evidence")


def q_markers(spark, sf):
    return _ctx(spark, sf).select("qid", F.array_join("markers", ",").alias("markers"),
                                  F.size("markers").alias("n_markers"))


def q_marker_blocks(spark, sf):
    r = retrieval.lexical_retrieval(spark, sf, K)
    return EV.marker_block_rows(r.hit_arrays, K).select("qid", "marker", _ints(F.col("blocks")).alias("blocks"))


def q_snippet_head_tail(spark, sf):
    a = retrieval.articles(spark, sf)
    return a.select("pmid", T.snippet_head_tail("abstract").alias("snippet"))


def q_snippet_words(spark, sf):
    a = retrieval.articles(spark, sf)
    return a.select("pmid", T.snippet_words("abstract").alias("snippet"))


def q_context_blocks(spark, sf):
    return _ctx(spark, sf).select("qid", "context")


def q_prompt_strict(spark, sf):
    return _ctx(spark, sf, "strict").select("qid", "prompt")


def q_prompt_simple(spark, sf):
    return _ctx(spark, sf, "simple").select("qid", "prompt")


# ------------------------------------------------------ synthesised answers

def mutate(answer: Column, qid: Column) -> Column:
    """Deterministic damage to a composed answer, one of eight kinds chosen by
    the question number, so every validation rule fires somewhere."""
    return damage(answer, F.substring(qid, 2, 10).cast("int") % 8)


def damage(answer: Column, kind: Column) -> Column:
    a = answer
    return (F.when(kind == 1, F.concat(a, F.lit("\nReferences:\n- none")))
            .when(kind == 2, F.replace(a, F.lit("[1]"), F.lit("[99]")))
            .when(kind == 3, F.regexp_replace(a, r"- Evidence also mentions[^\n]*\n", ""))
            .when(kind == 4, F.replace(a, F.lit("Answer:\n"), F.lit("Answer:\nZZQX9 is cited [1]. ")))
            .when(kind == 5, F.regexp_replace(a, r"(Biomarkers mentioned in Evidence:\n- [^\n]*)", "$1 [#]"))
            .when(kind == 6, F.replace(F.replace(a, F.lit("Answer:\n"), F.lit("")), F.lit("Takeaways:\n"), F.lit("")))
            .when(kind == 7, F.replace(F.replace(a, F.lit("Answer:\n"), F.lit("\nanswer :\n\n")),
                                       F.lit("Takeaways:\n"), F.lit("takeaways:  \n")))
            .otherwise(a))


def _answers(spark, sf):
    ctx = _ctx(spark, sf)
    return ctx.withColumn("raw", mutate(C.compose(F.col("hits"), K, mblocks=F.col("mblocks")), F.col("qid")))


def q_compose_answer(spark, sf):
    ctx = _ctx(spark, sf).withColumn("answer", C.compose(F.col("hits"), K, mblocks=F.col("mblocks")))
    return R.with_validation(ctx, k=K).select("qid", "answer", F.col("validation.ok").alias("ok"))


def q_normalize_headers(spark, sf):
    return _answers(spark, sf).select("qid", R.normalize("raw").alias("answer"))


def _norm(spark, sf):
    return _answers(spark, sf).withColumn("answer", R.normalize("raw"))


def q_section_split(spark, sf):
    return _norm(spark, sf).select("qid", R.answer_section("answer").alias("answer_sec"),
                                   R.marker_section("answer").alias("marker_sec"),
                                   R.takeaway_section("answer").alias("takeaway_sec"))


def q_citations(spark, sf):
    return _norm(spark, sf).select("qid", _ints(R.citations("answer")).alias("citations"))


def q_rule_references(spark, sf):
    return _norm(spark, sf).select("qid", R.has_references("answer").alias("has_references"))


def q_rule_not_relevant(spark, sf):
    return _norm(spark, sf).select("qid", R.has_not_relevant("answer").alias("has_not_relevant"))


def q_rule_range(spark, sf):
    return _norm(spark, sf).select("qid", R.citations_in_range("answer", K).alias("in_range"),
                                   R.citations_present("answer").alias("citations_present"),
                                   R.citations_valid("answer", K).alias("citations_valid"))


def q_rule_sentences(spark, sf):
    d = _norm(spark, sf)
    sec = R.answer_section("answer")
    return d.select("qid", F.size(R.sentences(sec)).alias("n_sentences"),
                    R.each_sentence_cited(sec).alias("all_cited"))


def q_rule_bullets(spark, sf):
    d = _norm(spark, sf)
    mb = R.bullets(R.marker_section("answer"))
    tb = R.bullets(R.takeaway_section("answer"))
    return d.select("qid", F.size(mb).alias("n_marker_bullets"), R.bullets_cited(mb, K).alias("markers_cited"),
                    F.size(tb).alias("n_takeaways"), R.bullets_cited(tb, K).alias("takeaways_cited"))


def q_rule_leakage(spark, sf):
    d = _norm(spark, sf)
    return d.select("qid", F.array_join(M.leaked_tokens("answer", "evidence"), ",").alias("leaked"))


def q_validate_answer(spark, sf):
    d = R.with_validation(_norm(spark, sf), k=K, out="v")
    return d.select("qid", F.col("v.ok").alias("ok"), F.array_join("v.issues", SEP).alias("issues"),
                    F.array_join("v.leaked_tokens", ",").alias("leaked_tokens"),
                    _ints(F.col("v.citations")).alias("citations"),
                    F.array_join("v.biomarkers_in_evidence", ",").alias("biomarkers_in_evidence"))


def q_repair_fallback(spark, sf):
    d = A.checked(_answers(spark, sf).withColumn("answer", F.col("raw")), K)
    d = A.with_fallback(d, K)
    return d.select("qid", "answer", "used_fallback", F.col("validation.ok").alias("ok"))


# ---------------------------------------------------------------- evaluation

def q_parse_relevant(spark, sf):
    """A1 over every document row: an id list written with mixed separators
    (string branch) and a float-typed id (numeric branch), parsed back."""
    d = corpus.table(spark, sf, "documents")
    raw = F.concat_ws(" ", F.lit(""), F.col("doc_id").cast("string"), F.lit("|"),
                      F.col("n_chars").cast("string"), F.lit(";"), F.col("source"), F.lit(",,"))
    parsed = E.parse_relevant(raw)
    numeric = E.parse_relevant_numeric(F.col("n_chars").cast("double"))
    return d.select(F.col("doc_id").cast("string").alias("pmid"), F.size(parsed).alias("n_relevant"),
                    F.array_join(parsed, ",").alias("relevant"), F.array_join(numeric, ",").alias("numeric"))


def _eval(spark, sf, run_llm=True):
    """Retrieval once; with generation on, the composed answer rides along as
    a column of the per-question frame (one plan, one retrieval)."""
    r = retrieval.lexical_retrieval(spark, sf, K)
    arrays = r.hit_arrays
    if run_llm:
        qh = EV.with_evidence(topk.with_hits(r.questions, r.hit_arrays), K, "simple")
        arrays = qh.select("qid", "hits", C.compose(F.col("hits"), K, mblocks=F.col("mblocks")).alias("answer"))
    return r, arrays


def q_eval_table(spark, sf):
    r, arrays = _eval(spark, sf)
    return E.eval_rows(r.questions, arrays, K)


def q_eval_metrics(spark, sf):
    r, arrays = _eval(spark, sf)
    rows = E.eval_rows(r.questions, arrays, K)
    m = E.eval_metrics(rows, K, "lexical-tfidf", "extractive-composer", True, "silver")
    return m.select(F.round("recall_at_k", 6).alias("recall_at_k"),
                    F.round("citations_present_rate", 6).alias("citations_present_rate"),
                    F.round("citations_valid_rate", 6).alias("citations_valid_rate"),
                    "k", "embed_model", "llm", "n_questions", "eval_csv")


def q_eval_runs(spark, sf):
    r, arrays = _eval(spark, sf)
    runs = E.eval_runs(r.questions, arrays)
    retr = F.array_join(F.transform("retrieval", lambda h: F.concat(
        h["rank"].cast("string"), F.lit(":"), h["pmid"], F.lit(":"), _fmt(h["score"]))), ";")
    return runs.select("qid", "question", F.array_join("relevant_pmids", ",").alias("relevant_pmids"),
                       retr.alias("retrieval"), "answer")


# ------------------------------------------------- outside question sets

def _benchmark_questions(spark, sf):
    b = corpus.table(spark, sf, "benchmark")
    return b.select(F.col("item_id").cast("string").alias("qid"), T.nz(F.col("text")).alias("question"))


def q_knn_benchmark(spark, sf):
    """R6 for an outside question set: every benchmark passage against the corpus."""
    r = retrieval.lexical_retrieval(spark, sf, K, questions=_benchmark_questions(spark, sf))
    return r.top.select("qid", F.col("rank").cast("int").alias("rank"), "pmid", "score")


def _conversation_pairs(spark, sf):
    """User turns as questions with the next assistant turn of the conversation."""
    c = corpus.table(spark, sf, "conversations")
    users = c.where(F.col("role") == "user").select(
        "conv_id", "turn", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
        T.nz(F.col("text")).alias("question"))
    replies = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), T.nz(F.col("text")).alias("raw"))
    return users.join(replies, ["conv_id", "turn"], "inner").select("qid", "question", "raw")


def _conversation_ctx(spark, sf):
    """The conversation pairs with what their hits' documents tell (``pmids``,
    markers, blocks, prompt), and the facts of those documents."""
    pairs = _conversation_pairs(spark, sf)
    r = retrieval.lexical_retrieval(spark, sf, K, questions=pairs.select("qid", "question"))
    facts = EV.document_facts(r.top, r.docs, "strict")
    ctx = EV.with_evidence(topk.with_hits(pairs, EV.hit_facts(r.top, facts, K)), K, "strict")
    return ctx.withColumn("pmids", F.transform("hits", lambda h: h["pmid"])), facts


def q_validate_conversations(spark, sf):
    """V11 on real answers: each user turn is a question (retrieved against the
    corpus), the next assistant turn of the same conversation is its answer."""
    ctx, facts = _conversation_ctx(spark, sf)
    ctx = materialize(ctx.select("qid", R.normalize("raw").alias("answer"), "pmids", "markers"), "conversations-ctx", free=True)      # read twice
    d = R.with_validation(EV.with_leaked(ctx, facts), k=K, out="v", leaked="leaked")
    return d.select("qid", F.col("v.ok").alias("ok"), F.array_join("v.issues", SEP).alias("issues"),
                    F.array_join("v.leaked_tokens", ",").alias("leaked_tokens"),
                    _ints(F.col("v.citations")).alias("citations"))


def q_answer_retries(spark, sf):
    """G1 + G3 + G4 on ready answers: a user turn is a question; its first answer
    is the reply of the conversation, the second a damaged composed one, the
    third a sound one or the reply again."""
    ctx, facts = _conversation_ctx(spark, sf)
    ctx = materialize(ctx.select("qid", "raw", "pmids", "markers", "mblocks", "prompt"), "retries-ctx", free=True)
    conv = F.element_at(F.split("qid", "-"), 1).cast("long")
    good = C.compose(F.col("hits"), K, mblocks=F.col("mblocks"))
    tries = F.array(F.col("raw"), damage(good, conv % 8), F.when(conv % 3 != 0, good).otherwise(F.col("raw")))
    ready = materialize(ctx.select("qid", F.posexplode(tries).alias("attempt", "raw_answer")), "retries-ready")
    out = A.answer_questions(ctx.drop("raw"), ready, K, max_retries=2, written=True, facts=facts)
    return out.select("qid", "answer", "retries_used", "used_fallback", F.col("validation.ok").alias("ok"))


# ------------------------------------------------------- sinks, read back

def q_sink_corpus_csv(spark, sf):
    """The corpus as CSV, read with its schema."""
    path = scratch_path(spark, "corpus-csv")
    corpus.write_articles_csv(retrieval.articles(spark, sf), path)
    return corpus.read_articles_csv(spark, path)


def q_sink_doc_store(spark, sf):
    """S15"""
    return retrieval.doc_store(spark, sf).select("pmid", "title", "abstract")


def q_sink_questions(spark, sf):
    """The question file is built once; a second call, whose set
    could not be built, leaves it alone."""
    path = scratch_path(spark, "questions-csv")
    arts = retrieval.articles(spark, sf)
    for n in (140, arts.count() + 1):
        jobs.question_file(spark, arts, path, n_questions=n, seed=13)
    return corpus.read_questions_csv(spark, path)


def _job_inputs(spark, sf):
    docvecs, vocab = retrieval.lexical_index(spark, sf)
    return retrieval.doc_store(spark, sf), docvecs, vocab


def q_sink_answers_json(spark, sf):
    """The answer job's records, written and read back."""
    qs = retrieval.silver_questions(spark, sf)
    rec = jobs.answer(qs, *_job_inputs(spark, sf), k=K, out_path=scratch_path(spark, "answers-json"))
    return rec.select("qid", "question", "k", "llm", "embed_model", F.size("retrieval").alias("n_hits"), "answer",
                      F.col("validation.ok").alias("ok"), "retries_used", "used_fallback")


def _evaluate(spark, sf, run_llm):
    path = scratch_path(spark, "eval")
    jobs.evaluate(spark, *_job_inputs(spark, sf), k=K, eval_csv=f"{path}/questions", run_llm=run_llm, out_dir=f"{path}/out")
    return f"{path}/out"


def q_sink_eval_metrics(spark, sf):
    """S18, A14 on: the metrics file."""
    m = spark.read.json(f"{_evaluate(spark, sf, True)}/eval_metrics")
    return m.select(F.round("`recall@k`", 6).alias("recall@k"), F.round("citations_present_rate", 6).alias("citations_present_rate"),
                    F.round("citations_valid_rate", 6).alias("citations_valid_rate"), "k", "llm", "n_questions")


def q_sink_eval_table(spark, sf):
    """S18, A14 off: the table file without generation; answer columns are 0."""
    schema = "qid string, recall_at_k double, citations_present int, citations_valid int"
    return spark.read.schema(schema).option("header", True).csv(f"{_evaluate(spark, sf, False)}/eval_table")


def q_eval_metrics_off(spark, sf):
    """A14 off: rates and the model's name are null."""
    r, arrays = _eval(spark, sf, run_llm=False)
    m = E.eval_metrics(E.eval_rows(r.questions, arrays, K), K, "lexical-tfidf", "extractive-composer", False, "silver")
    return m.select(F.round("recall_at_k", 6).alias("recall_at_k"), "citations_present_rate", "citations_valid_rate", "k",
                    "embed_model", "llm", "n_questions")


def q_dense_index(spark, sf):
    """Unit vectors as float32, written and read back."""
    e = corpus.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("pmid"), F.col("embedding").alias("vector"))
    idx = index.write_dense_index(e, scratch_path(spark, "dense-index"))
    return idx.select("pmid", F.array_join(F.transform("vector", lambda x: F.format_string("%.4f", x.cast("double"))), ",").alias("vec"))


def q_parse_relevant_list(spark, sf):
    """A1, list branch and whole numbers, over every document row."""
    d = corpus.table(spark, sf, "documents")
    ids = F.array(F.col("doc_id").cast("string"), F.lit(None), F.lit("  "), F.concat(F.lit(" "), F.col("source"), F.lit("\t")))
    return d.select(F.col("doc_id").cast("string").alias("pmid"), F.array_join(E.parse_relevant_list(ids), ",").alias("relevant"),
                    F.array_join(E.parse_relevant_numeric(F.col("n_chars") + F.lit(9007199254740993), "long"), ",").alias("numeric"))


def q_markers_limit(spark, sf):
    """E2-E6 on texts with more markers than the limit: every document in capitals."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    d = corpus.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("pmid"),
                                                    F.translate(T.nz("text"), lower, upper).alias("t"))
    return d.select("pmid", F.array_join(M.evidence_markers("t"), ",").alias("markers"), F.size(M.evidence_markers("t")).alias("n_markers"))


# --------------------------------------------------------------- ingestion

def _pages(spark, sf):
    return markup.flatten_pages(corpus.table(spark, sf, "pages"))


def q_ingest_markup_flatten(spark, sf):
    return _pages(spark, sf)


def q_ingest_filter_nonempty(spark, sf):
    return markup.keep_nonempty(_pages(spark, sf))


def q_ingest_dedup_keep_first(spark, sf):
    return markup.dedup_keep_first(markup.keep_nonempty(_pages(spark, sf)), "pmid", ["page_id"])


def corpus_levels():
    """The reference's query cascade followed by two levels that the test
    corpus can satisfy (its licence lines)."""
    return cascade.dedup_levels(cascade.reference_levels() + [
        cascade.level('"apache license"[Title/Abstract]'),
        cascade.level('mit[Title/Abstract] AND license[Title/Abstract]'),
    ])


def q_ingest_query_cascade(spark, sf):
    return cascade.choose_level(retrieval.articles(spark, sf), corpus_levels())


N_DOCS = 800


def q_ingest_semi_fetch(spark, sf):
    arts = retrieval.articles(spark, sf)
    ids, _ = cascade.search(arts, corpus_levels(), N_DOCS, order=["pmid"])
    return markup.semi_fetch(arts, ids).select("pmid", "title")


def q_index_meta(spark, sf):
    """The index sidecar (encoder name, number of indexed documents)."""
    return corpus.index_meta(retrieval.articles(spark, sf), "lexical-tfidf")


def q_ingest_meta(spark, sf):
    arts = retrieval.articles(spark, sf)
    ids, used = cascade.search(arts, corpus_levels(), N_DOCS, order=["pmid"])
    fetched = markup.dedup_keep_first(markup.semi_fetch(arts, ids), "pmid", ["pmid"])
    return corpus.fetch_meta(fetched, used, N_DOCS)


# ----------------------------------- ingestion cases derived from the tables

def q_ingest_filter_gaps(spark, sf):
    """S5 where it drops: pages with every tenth text and every seventh key taken away."""
    p = corpus.table(spark, sf, "pages")
    p = p.withColumn("html", F.when(F.col("page_id") % 10 != 0, F.col("html"))).withColumn(
        "url", F.when(F.col("page_id") % 7 != 0, F.col("url")).otherwise(F.lit("http://example.org/about")))
    return markup.keep_nonempty(markup.flatten_pages(p))


def q_ingest_cascade_level(spark, sf):
    """S6, S8 where a broader level matches: every 97th article speaks of cancer and a biomarker."""
    arts = retrieval.articles(spark, sf)
    told = F.when(F.col("pmid").cast("long") % 97 == 0, F.concat("abstract", F.lit(" A biomarker of cancer."))).otherwise(F.col("abstract"))
    return cascade.choose_level(arts.withColumn("abstract", told), corpus_levels())


def q_ingest_head_n(spark, sf):
    """A limit below the number of matches, over articles that each occur twice."""
    arts = retrieval.articles(spark, sf)
    ids, _ = cascade.search(arts.unionByName(arts), corpus_levels(), 5, order=["pmid"])
    return ids


#: Query texts of a user: fields, NOT, brackets, phrases, order of evaluation.
FREE_QUERIES = (
    '(license[Title/Abstract] OR "apache license"[Abstract] OR warranty[Abstract]) NOT "mit license"[Title/Abstract]',
    "license[Title]",
    "license[Abstract] NOT license[Title]",
    'the OR of[Title] AND (license OR "free software")',
    '"as is" warranty',
)
HEAD_N = 50


def q_ingest_free_query(spark, sf):
    """How many articles each of a user's query texts finds (one scan)."""
    levels = [cascade.level(t) for t in FREE_QUERIES]
    counts = cascade.level_counts(cascade.with_haystack(retrieval.articles(spark, sf)), levels)
    return counts.select(F.explode(F.array(*[F.struct(F.lit(i).alias("query"), F.lit(lv.name).alias("text"), F.col(f"n_{i}").alias("n"))
                                             for i, lv in enumerate(levels)])).alias("e")).select("e.*")


def q_ingest_relevance(spark, sf):
    """S1 with sort=relevance, S9: the first articles of a user's query, best first."""
    query = querytext.read(FREE_QUERIES[0])
    found = querytext.relevance(cascade.with_haystack(retrieval.articles(spark, sf)), query, cascade.HAYSTACK)
    return found.orderBy(F.desc("score"), "pmid").limit(HEAD_N)


def _article_xml(title, abstract):
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), F.col("pmid"), F.lit("</PMID><Article><ArticleTitle>"), plain(title),
                    F.lit("</ArticleTitle><Abstract><AbstractText>"), plain(abstract),
                    F.lit("</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>"))


def q_ingest_xml_files(spark, sf):
    """S4, S10 on article-set files made from the documents: the second file
    repeats every id of the first with another title; the first record stays."""
    arts = retrieval.articles(spark, sf)
    path = scratch_path(spark, "article-xml")
    for name, title in (("a", F.col("title")), ("b", F.concat(F.lit("Second "), F.col("title")))):
        arts.select(_article_xml(title, F.col("abstract")).alias("value")).write.option("lineSep", "\n").text(f"{path}/{name}")
    flat = markup.flatten_article_xml(markup.read_article_sets(spark, f"{path}/*"))
    flat = materialize(flat.drop("xml"), "xml-flat")                # parsed once, not once per side of the dedup join
    return markup.dedup_keep_first(markup.keep_nonempty(flat), "pmid", markup.POSITION).select("pmid", "title", "abstract")


#: Queries whose result comes from a model trained on the corpus, which SQL can't
#: express; ``tests/test_encoder.py`` holds them against NumPy.
TRAINED = {"encode_documents", "knn_encoded", "encoded_hit_at_k"}

REGISTRY = {
    "doc_text": q_doc_text,
    "l2_normalize": q_l2_normalize,
    "lexical_vectors": q_lexical_vectors,
    "knn_dense": q_knn_dense,
    "knn_dense_block": q_knn_dense_block,
    "dense_hit_at_k": q_dense_hit_at_k,
    "knn_lexical": q_knn_lexical,
    "encode_documents": q_encode_documents,
    "knn_encoded": q_knn_encoded,
    "encoded_hit_at_k": q_encoded_hit_at_k,
    "hits_with_docs": q_hits_with_docs,
    "silver_questions": q_silver_questions,
    "hit_at_k": q_hit_at_k,
    "evidence_text": q_evidence_text,
    "markers": q_markers,
    "marker_blocks": q_marker_blocks,
    "snippet_head_tail": q_snippet_head_tail,
    "snippet_words": q_snippet_words,
    "context_blocks": q_context_blocks,
    "prompt_strict": q_prompt_strict,
    "prompt_simple": q_prompt_simple,
    "compose_answer": q_compose_answer,
    "normalize_headers": q_normalize_headers,
    "section_split": q_section_split,
    "citations": q_citations,
    "rule_references": q_rule_references,
    "rule_not_relevant": q_rule_not_relevant,
    "rule_range": q_rule_range,
    "rule_sentences": q_rule_sentences,
    "rule_bullets": q_rule_bullets,
    "rule_leakage": q_rule_leakage,
    "validate_answer": q_validate_answer,
    "repair_fallback": q_repair_fallback,
    "parse_relevant": q_parse_relevant,
    "eval_table": q_eval_table,
    "eval_metrics": q_eval_metrics,
    "eval_runs": q_eval_runs,
    "knn_benchmark": q_knn_benchmark,
    "validate_conversations": q_validate_conversations,
    "ingest_markup_flatten": q_ingest_markup_flatten,
    "ingest_filter_nonempty": q_ingest_filter_nonempty,
    "ingest_dedup_keep_first": q_ingest_dedup_keep_first,
    "ingest_query_cascade": q_ingest_query_cascade,
    "ingest_semi_fetch": q_ingest_semi_fetch,
    "ingest_meta": q_ingest_meta,
    "index_meta": q_index_meta,
    "answer_retries": q_answer_retries,
    "sink_corpus_csv": q_sink_corpus_csv,
    "sink_doc_store": q_sink_doc_store,
    "sink_questions": q_sink_questions,
    "sink_answers_json": q_sink_answers_json,
    "sink_eval_metrics": q_sink_eval_metrics,
    "sink_eval_table": q_sink_eval_table,
    "eval_metrics_off": q_eval_metrics_off,
    "dense_index": q_dense_index,
    "parse_relevant_list": q_parse_relevant_list,
    "markers_limit": q_markers_limit,
    "ingest_filter_gaps": q_ingest_filter_gaps,
    "ingest_cascade_level": q_ingest_cascade_level,
    "ingest_head_n": q_ingest_head_n,
    "ingest_free_query": q_ingest_free_query,
    "ingest_relevance": q_ingest_relevance,
    "ingest_xml_files": q_ingest_xml_files,
}
