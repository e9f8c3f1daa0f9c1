"""Explicit schemas (no inference anywhere; ids are always strings)."""
from pyspark.sql import types as T

S = T.StringType()

ARTICLES = T.StructType([T.StructField("pmid", S), T.StructField("title", S), T.StructField("abstract", S)])

QUESTIONS_CSV = T.StructType([T.StructField("qid", S), T.StructField("question", S),
                              T.StructField("relevant_pmids", S)])

HIT = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("pmid", S), T.StructField("title", S),
    T.StructField("abstract", S), T.StructField("score", T.DoubleType()),
])

VALIDATION = T.StructType([
    T.StructField("ok", T.BooleanType()),
    T.StructField("issues", T.ArrayType(S)),
    T.StructField("leaked_tokens", T.ArrayType(S)),
    T.StructField("citations", T.ArrayType(T.LongType())),
    T.StructField("biomarkers_in_evidence", T.ArrayType(S)),
])

EVAL_ROW = T.StructType([
    T.StructField("qid", S), T.StructField("recall_at_k", T.DoubleType()),
    T.StructField("citations_present", T.IntegerType()), T.StructField("citations_valid", T.IntegerType()),
])
