"""End-to-end jobs (L1 ingest, L3 answer, L4 evaluate) with their sinks.

Each job is a few DataFrame plans plus writes; the only driver-side values
are bounded scalars (the winning query level, counts).  Results that feed
several sinks are written once and read back (shared checkpoint folder), so
the retrieval join is not recomputed per sink and lineage stays short.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.functions import compose as C
from citegrid.operators import answers as A
from citegrid.operators import evaluate as E
from citegrid.operators import evidence as EV
from citegrid.operators import lexical, silver, topk
from citegrid.plans import index
from citegrid.session import materialize
from citegrid.sources import cascade, corpus, markup


# ------------------------------------------------------------------- L1 ingest

@dataclass
class IngestResult:
    articles: DataFrame
    rejects: DataFrame
    query_used: str
    meta: DataFrame


def ingest(spark: SparkSession, xml_path: str, levels: list[cascade.Level], n_docs: int,
           out_dir: str | None = None) -> IngestResult:
    """Article-set XML -> flat rows -> query cascade -> head-N by relevance ->
    keep-first dedup -> corpus (CSV + Parquet), rejects, fetch metadata (S1–S12)."""
    flat = markup.flatten_article_xml(markup.read_article_sets(spark, xml_path))
    flat = materialize(flat.drop("xml"), "ingest-flat")
    good = markup.keep_nonempty(flat).select("pmid", "title", "abstract", *markup.POSITION)
    ids, used = cascade.search(good, levels, n_docs)
    fetched = markup.semi_fetch(good, ids)
    arts = markup.dedup_keep_first(fetched, "pmid", markup.POSITION).select("pmid", "title", "abstract")
    meta = corpus.fetch_meta(arts, used, n_docs)
    if out_dir:
        corpus.write_articles_csv(arts, f"{out_dir}/corpus_csv")
        corpus.write_doc_store(arts, f"{out_dir}/corpus")
        markup.rejects(flat).write.mode("overwrite").parquet(f"{out_dir}/rejects")
        corpus.write_json_single(meta, f"{out_dir}/fetch_meta")
        arts = spark.read.parquet(f"{out_dir}/corpus")
    return IngestResult(arts, markup.rejects(flat), used, meta)


# ------------------------------------------------------------------- L3 answer

def retrieve(questions: DataFrame, articles: DataFrame, postings: DataFrame, vocab: DataFrame,
             k: int) -> DataFrame:
    """R6 over a question table: one row per question with its hit array.

    The ranked ids are written once (the scoring is never recomputed) and
    joined with the articles.  Where ``articles`` is a doc store
    (``index.doc_store``), only the folders of the hits' buckets are read."""
    top = materialize(lexical.search(questions, postings, vocab, k), "hits-top")
    docs = index.lookup(articles, top) if "bucket" in articles.columns else articles
    return topk.with_hits(questions, topk.hit_arrays(topk.hits_with_docs(top, docs)))


def answer(questions: DataFrame, articles: DataFrame, postings: DataFrame, vocab: DataFrame, k: int = 6,
           generator: A.Generator | None = None, max_retries: int = 3, llm: str = "extractive-composer",
           embed_model: str = "lexical-tfidf", out_path: str | None = None,
           options: A.GenerationOptions = A.GenerationOptions(), make_client=None) -> DataFrame:
    """L3 for a whole question table: retrieve, assemble evidence and the
    strict prompt, generate (pluggable; default: the extractive composer),
    normalise, validate, retry, fall back; one nested record per question
    (S17 sink: one JSON line per question)."""
    ctx = EV.with_evidence(retrieve(questions, articles, postings, vocab, k), k, "strict")
    if generator is None:
        done = A.checked(ctx.withColumn("answer", C.compose(F.col("hits"), k, mblocks=F.col("mblocks")))
                         .withColumn("retries_used", F.lit(0)), k)
        done = A.with_fallback(done, k)
    else:
        done = A.answer_questions(ctx, generator, k, max_retries, options=options, make_client=make_client)
    record = done.select(
        "qid", "question", F.lit(k).alias("k"), F.lit(llm).alias("llm"), F.lit(embed_model).alias("embed_model"),
        F.col("hits").alias("retrieval"), "answer", "validation", "retries_used", "used_fallback")
    if out_path:
        record.write.mode("overwrite").json(out_path)
        return record.sparkSession.read.schema(record.schema).json(out_path)
    return record


# ----------------------------------------------------------------- L4 evaluate

@dataclass
class EvalResult:
    rows: DataFrame
    runs: DataFrame
    metrics: DataFrame


def question_file(spark: SparkSession, articles: DataFrame, path: str, n_questions: int = 140, seed: int = 13) -> DataFrame:
    """The question file, built if it is missing (and only then is the
    corpus counted, A4), read with its schema (S14)."""
    if not index.exists(spark, path):
        corpus.write_if_missing(silver.silver_questions(articles, n_questions, seed), path)
    return corpus.read_questions_csv(spark, path)


def evaluate(spark: SparkSession, articles: DataFrame, postings: DataFrame, vocab: DataFrame, k: int = 5,
             eval_csv: str | None = None, n_questions: int = 140, seed: int = 13, run_llm: bool = False,
             generator: A.Generator | None = None, llm: str = "extractive-composer",
             embed_model: str = "lexical-tfidf", out_dir: str | None = None) -> EvalResult:
    """L4: build the silver question file if missing (S19), read it typed
    (S14), retrieve for all questions in one job, per-question rows (A11),
    nested runs (A12), metrics (A13); sinks S18."""
    if eval_csv:
        questions = question_file(spark, articles, eval_csv, n_questions, seed)
    else:
        questions = silver.silver_questions(articles, n_questions, seed)
    qh = materialize(retrieve(questions, articles, postings, vocab, k), "eval-hits")
    answers = None
    if run_llm:
        ctx = EV.with_evidence(qh, k, "simple")
        if generator is None:
            answers = ctx.select("qid", C.compose(F.col("hits"), k, mblocks=F.col("mblocks")).alias("answer"))
        else:
            answers = A.generate(ctx, generator).select("qid", F.col("raw_answer").alias("answer"))
        answers = materialize(answers, "eval-answers")
    arrays = qh.select("qid", "hits")
    rows = E.eval_rows(questions, arrays, k, answers)
    runs = E.eval_runs(questions, arrays, answers)
    metrics = E.eval_metrics(rows, k, embed_model, llm, run_llm, eval_csv or "")
    if out_dir:
        corpus.write_json_single(E.metrics_file(metrics), f"{out_dir}/eval_metrics")
        rows.write.mode("overwrite").option("header", True).csv(f"{out_dir}/eval_table")
        runs.write.mode("overwrite").json(f"{out_dir}/eval_runs")
    return EvalResult(rows, runs, metrics)
