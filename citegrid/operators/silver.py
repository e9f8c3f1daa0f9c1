"""Silver question set built from the corpus (A3–A10).

Randomness is a pure function of (seed, id, position) through md5, so the set
is the same in every engine and under any partitioning (the reference's
single shared random stream is order-dependent and cannot be parallelised).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citegrid.functions.text import nz, strip

# Fixed value: title token shape.
TITLE_TOKEN = r"[A-Za-z0-9\-]+"
MIN_TOKENS_FOR_DROPOUT = 8
MIN_SURVIVORS = 4
FALLBACK_TOKENS = 6


def dropout_threshold(p: float) -> str:
    """u/2^32 > p  <=>  8-hex-digit prefix > floor(p * 2^32) (string compare)."""
    return format(int(p * (1 << 32)), "08x")


def sample_key(seed: int, pmid: Column) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), pmid))


def title_tokens(title: Column) -> Column:
    """A5"""
    return F.regexp_extract_all(nz(title), F.lit(TITLE_TOKEN), 0)


def question_from_title(pmid: Column, title: Column, seed: int = 13, p_drop: float = 0.30) -> Column:
    """Drop each token with probability ``p_drop`` when the title has ≥8
    tokens (fewer than 4 left -> first 6 tokens); shorter titles are used as is."""
    toks = title_tokens(title)
    thr = dropout_threshold(p_drop)
    keep = F.filter(toks, lambda t, i: F.substring(F.md5(F.concat(
        F.lit(str(seed)), F.lit("|"), pmid, F.lit("|"), i.cast("string"))), 1, 8) > F.lit(thr))
    dropped = F.when(F.size(keep) < MIN_SURVIVORS, F.slice(toks, 1, FALLBACK_TOKENS)).otherwise(keep)
    return F.when(F.size(toks) >= MIN_TOKENS_FOR_DROPOUT, F.array_join(dropped, " ")).otherwise(strip(title))


def silver_questions(articles: DataFrame, n: int = 140, seed: int = 13, p_drop: float = 0.30,
                     check_size: bool = True) -> DataFrame:
    """A10: ``(qid, question, relevant_pmids)`` for ``n`` sampled articles.

    A3 sampling is ``ORDER BY md5(seed|pmid) LIMIT n`` — a bounded top-n
    (TakeOrderedAndProject), not a full sort.  A4: fewer than ``n`` articles
    raises.  A9 numbers the sample q000… in sample order (window over the n
    sampled rows only).
    """
    pmid = F.col("pmid")
    if check_size:
        have = articles.count()
        if have < n:
            raise ValueError(f"Need at least {n} articles (found {have}).")
    picked = (articles.select(strip(pmid).alias("pmid"), "title")
              .withColumn("_key", sample_key(seed, F.col("pmid")))
              .orderBy("_key", "pmid").limit(n))
    w = Window.orderBy("_key", "pmid")
    return picked.select(
        F.format_string("q%03d", F.row_number().over(w) - 1).alias("qid"),
        question_from_title(F.col("pmid"), F.col("title"), seed, p_drop).alias("question"),
        F.col("pmid").alias("relevant_pmids"))
