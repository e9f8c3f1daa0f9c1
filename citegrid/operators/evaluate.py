"""Evaluation (A1, A2, A11–A13): per-question rows, run records, metrics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.functions import rules as R
from citegrid.functions.text import WS_RANGES, nz, strip

# Fixed value: separators between relevant ids.
RELEVANT_SEP = f"[,|;{WS_RANGES}]+"


def parse_relevant(x: Column | str) -> Column:
    """A1 on a string column: split on ``, | ;`` or whitespace, drop empties;
    the pieces stay as they are written (``123.0`` stays ``123.0``)."""
    c = nz(x if isinstance(x, Column) else F.col(x))
    parts = F.split(strip(c), RELEVANT_SEP, -1)
    return F.filter(parts, lambda p: p != "")


def parse_relevant_list(x: Column | str) -> Column:
    """A1 list branch: an array column -> its elements as stripped strings,
    nulls and empties dropped; a null array -> no ids."""
    c = F.coalesce(x if isinstance(x, Column) else F.col(x), F.array()).cast("array<string>")
    return F.filter(F.transform(c, lambda p: strip(nz(p))), lambda p: p != "")


def parse_relevant_numeric(x: Column | str, kind: str = "double") -> Column:
    """A1 numeric branch -> one-element list.  ``kind`` "long" keeps integers
    as they are; "double" writes integral floats without a fraction."""
    c = x if isinstance(x, Column) else F.col(x)
    none = F.array().cast("array<string>")
    if kind == "long":
        return F.when(c.isNull(), none).otherwise(F.array(c.cast("string")))
    as_str = F.when(c.isNull() | F.isnan(c), None).otherwise(
        F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string")))
    return F.when(as_str.isNull(), none).otherwise(F.array(as_str))


def hit_at_k(hit_ids: Column, relevant: Column) -> Column:
    """A2: 1.0 when any retrieved id is relevant, else 0.0 (also for no ids)."""
    return F.when(F.coalesce(F.arrays_overlap(hit_ids, relevant), F.lit(False)), 1.0).otherwise(0.0)


def eval_rows(questions: DataFrame, hit_arrays: DataFrame, k: int,
              answers: DataFrame | None = None) -> DataFrame:
    """``(qid, recall_at_k, citations_present, citations_valid)``.

    ``hit_arrays`` has one row per question (``qid, hits``); ``answers``
    (``qid, answer``) is optional — without it the answer columns are 0, as
    when generation is off.  Questions without any hit score 0.
    """
    q = questions.select("qid", parse_relevant("relevant_pmids").alias("rel"))
    df = q.join(hit_arrays, "qid", "left")
    ids = F.coalesce(F.transform(F.col("hits"), lambda h: h["pmid"]), F.array().cast("array<string>"))
    if answers is None and "answer" in hit_arrays.columns:
        present = R.citations_present(F.col("answer"))
        valid = R.citations_valid(F.col("answer"), k)
    elif answers is not None:
        df = df.join(answers.select("qid", "answer"), "qid", "left")
        present = R.citations_present(F.col("answer"))
        valid = R.citations_valid(F.col("answer"), k)
    else:
        present = F.lit(0)
        valid = F.lit(0)
    return df.select("qid", hit_at_k(ids, F.col("rel")).alias("recall_at_k"),
                     present.cast("int").alias("citations_present"),
                     valid.cast("int").alias("citations_valid"))


def eval_metrics(rows: DataFrame, k: int, embed_model: str, llm: str | None, run_llm: bool,
                 eval_csv: str = "") -> DataFrame:
    """One-row metrics; answer rates are null when generation is off."""
    rate = (lambda c: F.avg(c)) if run_llm else (lambda c: F.lit(None).cast("double"))
    return rows.agg(
        F.avg("recall_at_k").alias("recall_at_k"),
        rate("citations_present").alias("citations_present_rate"),
        rate("citations_valid").alias("citations_valid_rate"),
        F.lit(k).alias("k"),
        F.lit(embed_model).alias("embed_model"),
        F.lit(llm if run_llm else None).cast("string").alias("llm"),
        F.count(F.lit(1)).alias("n_questions"),
        F.lit(eval_csv).alias("eval_csv"),
    )


def metrics_file(metrics: DataFrame) -> DataFrame:
    """The metrics under the key names of the metrics file."""
    return metrics.withColumnRenamed("recall_at_k", "recall@k")


def eval_runs(questions: DataFrame, hit_arrays: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Nested run record per question: ``qid, question, relevant_pmids[],
    retrieval[], answer``."""
    df = questions.select("qid", "question", parse_relevant("relevant_pmids").alias("relevant_pmids")) \
        .join(hit_arrays, "qid", "left")
    if answers is not None:
        df = df.join(answers.select("qid", "answer"), "qid", "left")
        ans = nz(F.col("answer"))
    elif "answer" in hit_arrays.columns:
        ans = nz(F.col("answer"))
    else:
        ans = F.lit("")
    return df.select("qid", "question", "relevant_pmids",
                     F.coalesce(F.col("hits"), F.array()).alias("retrieval"), ans.alias("answer"))
