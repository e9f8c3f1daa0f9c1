"""Question-level evidence assembly (E1, E6, E7, E10–E12) over hit arrays.

Input is one row per question with its rank-sorted ``hits`` array (k
elements, built after the top-k), so every step is a per-row projection with
no further shuffle; the substring matching of markers to blocks (E7) stays
inside the row instead of becoming a theta join.

For many questions the texts of the hits would travel k times per question.
Then what questions ask of a document is worked out once per document
(``document_facts``) and the hits carry it (``hit_facts``); tokens that are
looked for in the evidence travel to the documents (``found_in``), not the
texts to the questions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.functions import compose as C
from citegrid.functions import markers as M
from citegrid.functions.text import nz
from citegrid.session import materialize


def with_evidence(qh: DataFrame, k: int, prompt_style: str = "strict", snippet: str | None = None,
                  question_col: str = "question") -> DataFrame:
    """Adds ``evidence``, ``markers``, ``mblocks`` (E7), ``context`` and
    ``prompt`` columns.

    ``prompt_style``: ``strict`` (answering path: head+tail snippets, rules,
    marker list) or ``simple`` (evaluation path: 550-char snippets).  Hits that
    carry facts (``hit_facts``) have their snippets, markers and blocks already;
    their evidence stays with the documents (``with_leaked``)."""
    if "mblocks" in qh.columns:
        df = qh.withColumn("markers", _markers_of(F.col("hits"))).withColumn("mblocks", F.coalesce("mblocks", F.array().cast(BLOCKS)))
        snippet = None
    else:
        snippet = snippet or _snippet_style(prompt_style)
        ev = C.evidence_text(F.col("hits"))
        df = qh.withColumn("evidence", ev).withColumn("markers", M.evidence_markers(F.col("evidence")))
        df = df.withColumn("mblocks", M.marker_blocks(F.col("markers"), F.col("hits"), k))
    df = df.withColumn("context", C.context_blocks(F.col("hits"), snippet))
    if prompt_style == "strict":
        prompt = C.prompt_strict(F.col(question_col), F.col("context"), F.col("markers"), k)
    else:
        prompt = C.prompt_simple(F.col(question_col), F.col("context"))
    return df.withColumn("prompt", prompt)


def _snippet_style(prompt_style: str) -> str:
    return "head_tail" if prompt_style == "strict" else "words"


BLOCKS = "array<struct<marker:string,blocks:array<int>>>"


def document_facts(top: DataFrame, articles: DataFrame, prompt_style: str = "strict") -> DataFrame:
    """``(pmid, title, snippet, markers, runs)`` of every document that is a hit,
    written: its snippet, its markers (as many as a question's evidence may
    list) and the runs that tokens are found in.  A document is read once,
    however many questions it answers."""
    hit = articles.select("pmid", "title", "abstract").join(top.select("pmid").distinct(), "pmid", "left_semi")
    text = F.concat(nz("title"), F.lit("\n"), nz("abstract"))
    return materialize(hit.select("pmid", "title", C.snippet("abstract", _snippet_style(prompt_style)).alias("snippet"),
                                  M.evidence_markers(text).alias("markers"), M.token_runs(text).alias("runs")), "evidence-documents", free=True)


def _markers_of(hits: Column) -> Column:
    """E6 from the markers of the hits: no token runs over the end of a text, and
    of the first markers of all texts each is among the first of its text."""
    return F.slice(F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["markers"])))), 1, M.MAX_MARKERS)


def found_in(asks: DataFrame, facts: DataFrame) -> DataFrame:
    """Of the ``tokens`` that a row asks of a document (``pmid``) those that are
    in its text, ignoring case, as ``found``."""
    return asks.join(facts.select("pmid", "runs"), "pmid").withColumn(
        "found", F.filter("tokens", lambda t: F.contains(F.col("runs"), F.lower(t)))).drop("runs", "tokens")


def hit_facts(top: DataFrame, facts: DataFrame, k: int) -> DataFrame:
    """One row per question, ``qid, hits, mblocks``: its rank-sorted hits with
    what is known of their documents, and E7 over them.  A hit that lists a
    marker itself is not asked for it."""
    hits = top.join(facts.select("pmid", "title", "snippet", "markers"), "pmid").select(
        "qid", F.struct(F.col("rank").cast("int").alias("rank"), "pmid", "title", "snippet", F.col("score").cast("double").alias("score"), "markers").alias("h"))
    arrays = materialize(hits.groupBy("qid").agg(F.array_sort(F.collect_list("h")).alias("hits")), "evidence-hits", free=True)
    asks = arrays.select("qid", _markers_of(F.col("hits")).alias("markers"), F.explode("hits").alias("h")).select(
        "qid", F.col("h.rank").alias("rank"), F.col("h.pmid").alias("pmid"), F.array_except("markers", "h.markers").alias("tokens"))
    found = found_in(asks.where(F.size("tokens") > 0), facts).where(F.size("found") > 0)
    found = found.groupBy("qid").agg(F.collect_list(F.struct("rank", "found")).alias("others"))

    def blocks_of(m: Column) -> Column:
        ranks = F.transform("hits", lambda h: F.when(
            (h["rank"] >= 1) & (h["rank"] <= k) & (F.array_contains(h["markers"], m) | F.exists(
                F.coalesce("others", F.array().cast("array<struct<rank:int,found:array<string>>>")),
                lambda o: (o["rank"] == h["rank"]) & F.array_contains(o["found"], m))), h["rank"]))
        return F.array_distinct(F.filter(ranks, lambda r: r.isNotNull()))

    mblocks = F.transform("markers", lambda m: F.struct(m.alias("marker"), blocks_of(m).alias("blocks")))
    return (arrays.join(found, "qid", "left").withColumn("markers", _markers_of(F.col("hits")))
            .select("qid", "hits", mblocks.alias("mblocks")))


def with_leaked(df: DataFrame, facts: DataFrame, answer: str = "answer", out: str = "leaked", where: Column | None = None) -> DataFrame:
    """V7 (``markers.leaked_tokens``) where the evidence stays with its
    documents, of the rows that ``where`` holds for (none in the others).  ``df`` has ``qid, markers, pmids``, one list of hits
    per ``qid``, and is read twice.  Markers of the evidence are in it; only other
    tokens of an answer are asked of the documents."""
    told = df.withColumn("_tokens", M.marker_tokens(answer) if where is None else F.when(where, M.marker_tokens(answer)).otherwise(F.array().cast("array<string>")))
    told = told.withColumn("_tokens", F.array_except("_tokens", "markers"))
    asks = told.where(F.size("_tokens") > 0).select("qid", F.col("_tokens").alias("tokens"), F.explode("pmids").alias("pmid"))
    found = found_in(asks, facts).select("qid", F.explode("found").alias("token")).groupBy("qid").agg(F.collect_set("token").alias("_found"))
    return (told.join(found, "qid", "left")
            .withColumn(out, F.array_except("_tokens", F.coalesce("_found", F.array().cast("array<string>")))).drop("_tokens", "_found"))


def marker_block_rows(qh: DataFrame, k: int) -> DataFrame:
    """E7 as rows: ``(qid, marker, blocks)`` for every evidence marker."""
    ev = C.evidence_text(F.col("hits"))
    mb = M.marker_blocks(M.evidence_markers(ev), F.col("hits"), k)
    return qh.select("qid", F.explode(mb).alias("mb")).select(
        "qid", F.col("mb.marker").alias("marker"), F.col("mb.blocks").alias("blocks"))
