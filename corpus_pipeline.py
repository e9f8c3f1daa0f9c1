"""Corpus pipeline: documents to packed training bins, one operator per stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citegrid.llm import credentials, mixing, ngram_join, packing, toxicity
from citegrid.session import materialize, remove_tables


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies (five-word shingles, Jaccard 0.8 or more): one document of each group stays."""
    return ngram_join.keep_one(docs, ngram_join.Rule(k=5, num=80, den=100))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; every document stays."""
    return credentials.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it (0 to 3 times)."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its bin."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", ngram_stage),
    ("secret_scan", secrets_stage),
    ("source_mixing", mixing_stage),
    ("bin_packing", packing_stage),
]

#: Trained scores, hash thresholds and bin packing have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        written: list[str] = []
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", written)
        remove_tables(spark, before)         # of the stages' results the last one stays
        before = written
    return docs
