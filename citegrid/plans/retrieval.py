"""Retrieval plans over the driver tables: corpus -> questions -> top-k hits."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from citegrid.operators import dense, encoder, lexical, silver, topk
from citegrid.plans import index
from citegrid.session import materialize
from citegrid.sources import corpus


@dataclass
class Retrieval:
    articles: DataFrame
    questions: DataFrame
    top: DataFrame        # qid, pmid, score, rank
    hits: DataFrame       # qid, rank, pmid, title, abstract, score
    hit_arrays: DataFrame  # qid, hits (rank-sorted array)
    docs: DataFrame       # pmid, title, abstract of the hits (and others of their buckets)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.articles_from_documents(corpus.table(spark, sf_dir, "documents"))


def silver_questions(spark: SparkSession, sf_dir: str, n: int = 140, seed: int = 13) -> DataFrame:
    return silver.silver_questions(articles(spark, sf_dir), n=n, seed=seed, check_size=False)


def lexical_index(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
    """The written lexical index of the documents table (doc vectors, vocab)."""
    return index.lexical_index(spark, lambda: articles(spark, sf_dir),
                               [f"{sf_dir.rstrip('/')}/documents.parquet"], rebuild=rebuild)


def lexical_retrieval(spark: SparkSession, sf_dir: str, k: int = 5, questions: DataFrame | None = None,
                      n_questions: int = 140, seed: int = 13, postings: DataFrame | None = None,
                      vocab: DataFrame | None = None) -> Retrieval:
    """Silver questions (or the given ones) against the lexical index.

    ``postings``/``vocab`` may be given; otherwise the written index of the
    documents is read (and built once if absent, see ``plans.index``)."""
    arts = articles(spark, sf_dir)
    qs = questions if questions is not None else silver.silver_questions(
        arts, n=n_questions, seed=seed, check_size=False)
    qs = materialize(qs, "question-set")           # read by the search, the hit table and the evaluation
    if postings is None or vocab is None:
        postings, vocab = lexical_index(spark, sf_dir)
    top = materialize(lexical.search(qs, postings, vocab, k), "hits-top", free=True)
    docs = index.lookup(doc_store(spark, sf_dir), top)
    hits = topk.hits_with_docs(top, docs)
    return Retrieval(arts, qs, top, hits, topk.hit_arrays(hits), docs)


def text_encoder(spark: SparkSession, sf_dir: str) -> encoder.Encoder:
    """The encoder trained on the documents table (and written, for the next time)."""
    return index.text_encoder(spark, lambda: articles(spark, sf_dir), [f"{sf_dir.rstrip('/')}/documents.parquet"])


def encoded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pmid, vector)`` of the documents table."""
    docvecs, _ = lexical_index(spark, sf_dir)
    return encoder.encode(docvecs, text_encoder(spark, sf_dir))


def encoded_retrieval(spark: SparkSession, sf_dir: str, k: int = 5, questions: DataFrame | None = None,
                      n_questions: int = 140, seed: int = 13) -> Retrieval:
    """Silver questions (or the given ones) against the encoded documents."""
    arts = articles(spark, sf_dir)
    qs = questions if questions is not None else silver.silver_questions(arts, n=n_questions, seed=seed, check_size=False)
    qs = materialize(qs, "question-set")
    _, vocab = lexical_index(spark, sf_dir)
    model = text_encoder(spark, sf_dir)
    docs = materialize(encoded_documents(spark, sf_dir), "encoded-documents")
    top = materialize(dense.knn(encoder.encode_questions(qs, vocab, model), docs, k), "encoded-top")
    docs = index.lookup(doc_store(spark, sf_dir), top)
    hits = topk.hits_with_docs(top, docs)
    return Retrieval(arts, qs, top, hits, topk.hit_arrays(hits), docs)


def doc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written doc store of the documents table."""
    return index.doc_store(spark, lambda: articles(spark, sf_dir), [f"{sf_dir.rstrip('/')}/documents.parquet"])
