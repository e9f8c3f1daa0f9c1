"""Typed scans and sinks (S11, S13, S14, S19) on question/article fixtures."""
import pandas as pd
from pyspark.sql import functions as F

from citegrid.operators import evaluate, silver
from citegrid.sources import corpus

# Four rows of the reference's question file worth keeping as cases.
QUESTION_ROWS = [
    ("q059", "Integrative Pan-Cancer Reveals the Oncogenic Role of Validation of s Role Breast", "39051055"),
    ("q104", "Mammaprint™: a comprehensive review.", "30156427"),
    ("q113", "Multipathway regulation induced by 4- morpholine derivatives against triple-negative breast cancer",
     "38314850"),
    ("q130", "HOXD10 expression in human breast cancer.", "25081374"),
]


def test_typed_question_scan(spark, tmp_path):
    p = tmp_path / "eval_questions.csv"
    pd.DataFrame(QUESTION_ROWS, columns=["qid", "question", "relevant_pmids"]).to_csv(p, index=False)
    df = corpus.read_questions_csv(spark, str(p))
    assert dict(df.dtypes) == {"qid": "string", "question": "string", "relevant_pmids": "string"}
    rows = {r["qid"]: r for r in df.select("*", evaluate.parse_relevant("relevant_pmids").alias("rel")).collect()}
    assert rows["q104"]["question"] == "Mammaprint™: a comprehensive review."
    assert all(r["rel"] == [r["relevant_pmids"]] for r in rows.values())
    # short title (< 8 tokens) is used verbatim, punctuation and sign kept
    q = spark.createDataFrame([("1", rows["q104"]["question"])], "pmid string, title string") \
        .select(silver.question_from_title(F.col("pmid"), F.col("title")).alias("q")).first()["q"]
    assert q == "Mammaprint™: a comprehensive review."
    toks = spark.createDataFrame([(rows["q113"]["question"],)], "t string") \
        .select(silver.title_tokens(F.col("t")).alias("x")).first()["x"]
    assert "4-" in toks


def test_corpus_csv_roundtrip_multiline(spark, tmp_path):
    arts = spark.createDataFrame([("1", "T1", 'line one\nline "two"'), ("2", "T2", None)],
                                 "pmid string, title string, abstract string")
    corpus.write_articles_csv(arts, str(tmp_path / "c"))
    back = {r["pmid"]: r for r in corpus.read_articles_csv(spark, str(tmp_path / "c")).collect()}
    assert back["1"]["abstract"] == 'line one\nline "two"'
    assert back["2"]["abstract"] == ""


def test_write_if_missing_keeps_existing(spark, tmp_path):
    a = spark.createDataFrame([("q1", "x", "1")], "qid string, question string, relevant_pmids string")
    b = spark.createDataFrame([("q9", "y", "2")], "qid string, question string, relevant_pmids string")
    corpus.write_if_missing(a, str(tmp_path / "q"))
    corpus.write_if_missing(b, str(tmp_path / "q"))
    assert [r["qid"] for r in corpus.read_questions_csv(spark, str(tmp_path / "q")).collect()] == ["q1"]
