"""Oracle statements keyed like the registered queries."""
from oracle import sql as S
from oracle.sql import ARTICLES, LEXICAL, QH, lexical_search, silver, with_

K = 5
RET = [ARTICLES, silver(), LEXICAL, lexical_search(K)]
PREFIX = with_(*RET)
CTX = with_(*RET, QH, S.evidence_ctx(K, "head_tail"))
CTX_SIMPLE = with_(*RET, QH, S.evidence_ctx(K, "words"))
ANS = with_(*RET, QH, S.evidence_ctx(K, "head_tail"),
            f"comp AS (SELECT *, {S.compose(K)} AS composed FROM ctx2)",
            f"raw AS (SELECT *, {S.mutate('composed')} AS raw FROM comp)",
            f"norm AS (SELECT *, {S.normalize('raw')} AS answer FROM raw)",
            f"lk AS (SELECT *, {S.leaked('answer', 'evidence')} AS leaked FROM norm)",
            f"val AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM norm)")

STATEMENTS = {
    "doc_text": with_(ARTICLES) + f"SELECT pmid, {S.DOC_TEXT} AS doc_text FROM articles",
    "l2_normalize": f"""
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm_in FROM e),
        o AS (SELECT vec_id, norm_in, list_transform(v, lambda x: x / norm_in) AS nv FROM n)
        SELECT vec_id, round(norm_in, 6) AS norm_in,
               round(sqrt(list_sum(list_transform(nv, lambda x: x * x))), 6) AS norm_out,
               array_to_string(list_transform(nv, lambda x: printf('%.6f', x)), ',') AS vec FROM o""",
    "lexical_vectors": with_(ARTICLES, LEXICAL) + "SELECT pmid, term, round(w, 6) AS w FROM postings",
    "silver_questions": with_(ARTICLES, silver()) + "SELECT * FROM silver",
    "knn_lexical": PREFIX + "SELECT qid, rank, pmid, score FROM top",
    "hits_with_docs": PREFIX + "SELECT * FROM hits",
    "hit_at_k": with_(*RET, QH) + """
        SELECT s.qid, CASE WHEN list_has_any(coalesce(list_transform(qh.hits, lambda h: h.pmid), []),
                                             list_filter(string_split_regex(trim(s.relevant_pmids), '[,|;\\s]+'), lambda p: p <> ''))
                           THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS recall_at_k
        FROM silver s LEFT JOIN qh USING (qid)""",
    "evidence_text": CTX + "SELECT qid, evidence FROM ctx2",
    "markers": CTX + "SELECT qid, array_to_string(markers, ',') AS markers, CAST(len(markers) AS INTEGER) AS n_markers FROM ctx2",
    "marker_blocks": CTX + f"""
        SELECT qid, m.marker AS marker, {S.ints('m.blocks')} AS blocks
        FROM (SELECT qid, unnest(mblocks) AS m FROM ctx2)""",
    "snippet_head_tail": with_(ARTICLES) + f"SELECT pmid, {S.snippet_head_tail('abstract')} AS snippet FROM articles",
    "snippet_words": with_(ARTICLES) + f"SELECT pmid, {S.snippet_words('abstract')} AS snippet FROM articles",
    "context_blocks": CTX + "SELECT qid, context FROM ctx2",
    "prompt_strict": CTX + f"SELECT qid, {S.prompt_strict(K)} AS prompt FROM ctx2",
    "prompt_simple": CTX_SIMPLE + f"SELECT qid, {S.prompt_simple()} AS prompt FROM ctx2",
    "compose_answer": with_(*RET, QH, S.evidence_ctx(K, "head_tail"),
                            f"comp AS (SELECT *, {S.compose(K)} AS answer FROM ctx2)",
                            f"val AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM comp)")
    + "SELECT qid, answer, len(issues) = 0 AS ok FROM val",
    "normalize_headers": ANS + "SELECT qid, answer FROM norm",
    "section_split": ANS + f"""SELECT qid, {S.ans_sec('answer')} AS answer_sec, {S.mark_sec('answer')} AS marker_sec,
                                      {S.take_sec('answer')} AS takeaway_sec FROM norm""",
    "citations": ANS + f"SELECT qid, {S.ints(S.citations('answer'))} AS citations FROM norm",
    "rule_references": ANS + f"SELECT qid, {S.has_refs('answer')} AS has_references FROM norm",
    "rule_not_relevant": ANS + f"SELECT qid, {S.not_relevant('answer')} AS has_not_relevant FROM norm",
    "rule_range": ANS + f"""SELECT qid, {S.cites_in_range('answer', K)} AS in_range,
                                   {S.present('answer')} AS citations_present,
                                   CAST({S.cites_in_range('answer', K)} AS INTEGER) AS citations_valid FROM norm""",
    "rule_sentences": ANS + f"""SELECT qid, CAST(len({S.sentences(S.ans_sec('answer'))}) AS INTEGER) AS n_sentences,
                                       {S.each_cited(S.ans_sec('answer'))} AS all_cited FROM norm""",
    "rule_bullets": ANS + f"""
        SELECT qid, CAST(len(mb) AS INTEGER) AS n_marker_bullets, {S.bullets_cited('mb', K)} AS markers_cited,
               CAST(len(tb) AS INTEGER) AS n_takeaways, {S.bullets_cited('tb', K)} AS takeaways_cited
        FROM (SELECT qid, {S.bullets(S.mark_sec('answer'))} AS mb, {S.bullets(S.take_sec('answer'))} AS tb FROM norm)""",
    "rule_leakage": ANS + "SELECT qid, array_to_string(leaked, ',') AS leaked FROM lk",
    "validate_answer": ANS + f"""
        SELECT val.qid, len(issues) = 0 AS ok, array_to_string(issues, ' || ') AS issues,
               array_to_string(lk.leaked, ',') AS leaked_tokens, {S.ints(S.citations('val.answer'))} AS citations,
               array_to_string(val.markers, ',') AS biomarkers_in_evidence
        FROM val JOIN lk USING (qid)""",
    "repair_fallback": ANS + f"""
        , fb AS (SELECT qid, used_fallback, CASE WHEN used_fallback THEN {S.normalize('composed')} ELSE answer END AS answer, evidence
                 FROM (SELECT *, len(issues) > 0 AS used_fallback FROM val)),
        fbv AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM fb)
        SELECT qid, answer, used_fallback, len(issues) = 0 AS ok FROM fbv""",
    "parse_relevant": f"""
        WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS pmid,
                          concat_ws(' ', '', CAST(doc_id AS VARCHAR), '|', CAST(n_chars AS VARCHAR), ';', source, ',,') AS raw,
                          CAST(n_chars AS DOUBLE) AS num FROM documents),
        p AS (SELECT pmid, list_filter(string_split_regex({S.strip('raw')}, '[,|;\\s]+'), lambda x: x <> '') AS parsed,
                     CASE WHEN num IS NULL OR isnan(num) THEN [] WHEN num = floor(num) THEN [CAST(CAST(num AS DECIMAL(38,0)) AS VARCHAR)]
                          ELSE [CAST(num AS VARCHAR)] END AS numeric FROM r)
        SELECT pmid, CAST(len(parsed) AS INTEGER) AS n_relevant, array_to_string(parsed, ',') AS relevant,
               array_to_string(numeric, ',') AS numeric FROM p""",
}

EVAL = with_(*RET, QH, S.evidence_ctx(K, "words"),
             f"ans AS (SELECT qid, {S.compose(K)} AS answer FROM ctx2)",
             f"""rows AS (
                SELECT s.qid,
                       CASE WHEN list_has_any(coalesce(list_transform(qh.hits, lambda h: h.pmid), []),
                                              list_filter(string_split_regex(trim(s.relevant_pmids), '[,|;\\s]+'), lambda p: p <> ''))
                            THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS recall_at_k,
                       {S.present("coalesce(a.answer, '')")} AS citations_present,
                       CAST({S.cites_in_range("coalesce(a.answer, '')", K)} AS INTEGER) AS citations_valid,
                       s.question, s.relevant_pmids, qh.hits, coalesce(a.answer, '') AS answer
                FROM silver s LEFT JOIN qh USING (qid) LEFT JOIN ans a USING (qid))""")

STATEMENTS["eval_table"] = EVAL + "SELECT qid, recall_at_k, citations_present, citations_valid FROM rows"
STATEMENTS["eval_metrics"] = EVAL + f"""
    SELECT round(avg(recall_at_k), 6) AS recall_at_k, round(avg(citations_present), 6) AS citations_present_rate,
           round(avg(citations_valid), 6) AS citations_valid_rate, {K} AS k, 'lexical-tfidf' AS embed_model,
           'extractive-composer' AS llm, count(*) AS n_questions, 'silver' AS eval_csv FROM rows"""
STATEMENTS["eval_runs"] = EVAL + """
    SELECT qid, question,
           array_to_string(list_filter(string_split_regex(trim(relevant_pmids), '[,|;\\s]+'), lambda p: p <> ''), ',') AS relevant_pmids,
           array_to_string(list_transform(coalesce(hits, []), lambda h: CAST(h.rank AS VARCHAR) || ':' || h.pmid || ':' || printf('%.6f', h.score)), ';') AS retrieval,
           answer FROM rows"""

DENSE = f"""
    WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    s AS (SELECT a.vec_id AS qid, b.vec_id AS neighbor, round(list_dot_product(a.v, b.v), 6) AS score
          FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    t AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, neighbor) AS INTEGER) AS rank FROM s)
    SELECT qid, rank, neighbor, score FROM t WHERE rank <= {K}"""
STATEMENTS["knn_dense"] = DENSE
STATEMENTS["knn_dense_block"] = DENSE

STATEMENTS["ingest_markup_flatten"] = with_(S.PAGES) + "SELECT page_id, pmid, title, abstract FROM flat"
STATEMENTS["ingest_filter_nonempty"] = with_(S.PAGES) + "SELECT page_id, pmid, title, abstract FROM nonempty"
STATEMENTS["ingest_dedup_keep_first"] = with_(S.PAGES) + """
    SELECT pmid, page_id, title, abstract FROM (
      SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY page_id) AS rn FROM nonempty) WHERE rn = 1"""

_T = S.tiab
LEVELS = [
    ('(breast cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract] '
     'OR transcriptomic[Title/Abstract])',
     f"{_T('breast cancer')} AND ({_T('biomarker')} OR {_T('gene expression')} OR {_T('transcriptomic')})"),
    ('(breast cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract])',
     f"{_T('breast cancer')} AND ({_T('biomarker')} OR {_T('gene expression')})"),
    ('(cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract])',
     f"{_T('cancer')} AND ({_T('biomarker')} OR {_T('gene expression')})"),
    ('biomarker[Title/Abstract] AND "gene expression"[Title/Abstract]', f"{_T('biomarker')} AND {_T('gene expression')}"),
    ("cancer[Title/Abstract]", _T("cancer")),
    ('"apache license"[Title/Abstract]', _T("apache license")),
    ("mit[Title/Abstract] AND license[Title/Abstract]", f"{_T('mit')} AND {_T('license')}"),
]
_counts = ", ".join(f"count_if({p}) AS n_{i}" for i, (_, p) in enumerate(LEVELS))
_union = " UNION ALL ".join(f"SELECT {i} AS level, {S.sq(n)} AS query_used, n_{i} AS n_matched FROM counts"
                            for i, (n, _) in enumerate(LEVELS))
CASCADE = with_(ARTICLES, S.HAY, f"counts AS (SELECT {_counts} FROM hay)",
                f"levels AS ({_union})",
                "chosen AS (SELECT * FROM levels WHERE n_matched > 0 ORDER BY level LIMIT 1)")
STATEMENTS["ingest_query_cascade"] = CASCADE + "SELECT level, query_used, n_matched FROM chosen"
_case = " ".join(f"WHEN {i} THEN {p}" for i, (_, p) in enumerate(LEVELS))
FETCH = CASCADE.rstrip() + f""",
ids AS (SELECT pmid FROM hay WHERE CASE (SELECT level FROM chosen) {_case} END ORDER BY pmid LIMIT 800),
fetched AS (SELECT pmid, title FROM articles WHERE pmid IN (SELECT pmid FROM ids))
"""
STATEMENTS["ingest_semi_fetch"] = FETCH + "SELECT pmid, title FROM fetched"
STATEMENTS["ingest_meta"] = FETCH + """SELECT (SELECT query_used FROM chosen) AS query_used, 800 AS requested_n_docs,
    count(*) AS saved_n_docs FROM fetched"""

BQ = "bq AS (SELECT CAST(item_id AS VARCHAR) AS qid, coalesce(text, '') AS question FROM benchmark)"
STATEMENTS["knn_benchmark"] = with_(ARTICLES, LEXICAL, BQ, lexical_search(K, "bq")) + "SELECT qid, rank, pmid, score FROM top"

CONV = """
users AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS qid,
                 coalesce(text, '') AS question FROM conversations WHERE role = 'user'),
replies AS (SELECT conv_id, turn - 1 AS turn, coalesce(text, '') AS raw FROM conversations WHERE role = 'assistant'),
pairs AS (SELECT qid, question, raw FROM users JOIN replies USING (conv_id, turn))"""
STATEMENTS["validate_conversations"] = with_(
    ARTICLES, LEXICAL, CONV, lexical_search(K, "pairs"), S.QH,
    f"""cctx AS (SELECT qh.qid, qh.evidence, {S.evidence_markers('qh.evidence')} AS markers, {S.normalize('p.raw')} AS answer
               FROM qh JOIN pairs p USING (qid))""",
    f"clk AS (SELECT *, {S.leaked('answer', 'evidence')} AS leaked FROM cctx)",
    f"cval AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM clk)") + f"""
    SELECT qid, len(issues) = 0 AS ok, array_to_string(issues, ' || ') AS issues,
           array_to_string(leaked, ',') AS leaked_tokens, {S.ints(S.citations('answer'))} AS citations FROM cval"""

STATEMENTS["index_meta"] = "SELECT 'lexical-tfidf' AS embedding_model, count(*) AS n_docs FROM documents"

STATEMENTS["dense_hit_at_k"] = DENSE.replace("SELECT qid, rank, neighbor, score FROM t WHERE rank <= 5", """
    SELECT t.qid, max(CASE WHEN n.label = q.label THEN 1.0 ELSE 0.0 END)::DOUBLE AS hit
    FROM t JOIN embeddings n ON n.vec_id = t.neighbor JOIN embeddings q ON q.vec_id = t.qid
    WHERE t.rank <= 5 GROUP BY t.qid""")

CONV_CTX = with_(ARTICLES, LEXICAL, CONV, lexical_search(K, "pairs"), S.QH, S.evidence_ctx(K, "head_tail", "pairs"),
                 f"ccomp AS (SELECT c.*, p.raw, CAST(split_part(c.qid, '-', 1) AS BIGINT) AS conv, {S.compose(K)} AS composed "
                 "FROM ctx2 c JOIN pairs p USING (qid))",
                 f"""tries AS (SELECT qid, evidence, composed, 0 AS attempt, raw AS a FROM ccomp
                   UNION ALL SELECT qid, evidence, composed, 1, {S.mutate('composed', kind='(conv % 8)')} FROM ccomp
                   UNION ALL SELECT qid, evidence, composed, 2, CASE WHEN conv % 3 <> 0 THEN composed ELSE raw END FROM ccomp)""",
                 f"tnorm AS (SELECT qid, evidence, composed, attempt, {S.normalize('a')} AS answer FROM tries)",
                 f"tval AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM tnorm)",
                 "first_ok AS (SELECT qid, min(CASE WHEN len(issues) = 0 THEN attempt END) AS good FROM tval GROUP BY qid)")
STATEMENTS["answer_retries"] = CONV_CTX + f"""
    , picked AS (SELECT t.qid, t.evidence, CASE WHEN f.good IS NULL THEN {S.normalize('t.composed')} ELSE t.answer END AS answer,
                        t.attempt AS retries_used, f.good IS NULL AS used_fallback
                 FROM tval t JOIN first_ok f ON t.qid = f.qid AND t.attempt = coalesce(f.good, 2))
    SELECT qid, answer, CAST(retries_used AS INTEGER) AS retries_used, used_fallback,
           len({S.issues('answer', 'evidence', K)}) = 0 AS ok FROM picked"""

STATEMENTS["sink_corpus_csv"] = with_(ARTICLES) + "SELECT pmid, title, abstract FROM articles"
STATEMENTS["sink_doc_store"] = STATEMENTS["sink_corpus_csv"]
STATEMENTS["sink_questions"] = STATEMENTS["silver_questions"]
STATEMENTS["sink_answers_json"] = with_(
    *RET, QH, S.evidence_ctx(K, "head_tail"), f"comp AS (SELECT *, {S.normalize(S.compose(K))} AS answer FROM ctx2)",
    f"val AS (SELECT *, {S.issues('answer', 'evidence', K)} AS issues FROM comp)") + f"""
    SELECT qid, question, {K} AS k, 'extractive-composer' AS llm, 'lexical-tfidf' AS embed_model, CAST(len(hits) AS INTEGER) AS n_hits,
           answer, len(issues) = 0 AS ok, 0 AS retries_used, len(issues) > 0 AS used_fallback FROM val"""
STATEMENTS["sink_eval_metrics"] = EVAL + f"""
    SELECT round(avg(recall_at_k), 6) AS "recall@k", round(avg(citations_present), 6) AS citations_present_rate,
           round(avg(citations_valid), 6) AS citations_valid_rate, CAST({K} AS BIGINT) AS k, 'extractive-composer' AS llm,
           count(*) AS n_questions FROM rows"""
STATEMENTS["sink_eval_table"] = EVAL + "SELECT qid, recall_at_k, 0 AS citations_present, 0 AS citations_valid FROM rows"
STATEMENTS["eval_metrics_off"] = EVAL + f"""
    SELECT round(avg(recall_at_k), 6) AS recall_at_k, CAST(NULL AS DOUBLE) AS citations_present_rate,
           CAST(NULL AS DOUBLE) AS citations_valid_rate, {K} AS k, 'lexical-tfidf' AS embed_model, CAST(NULL AS VARCHAR) AS llm,
           count(*) AS n_questions FROM rows"""
STATEMENTS["dense_index"] = """
    WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e)
    SELECT CAST(vec_id AS VARCHAR) AS pmid,
           array_to_string(list_transform(v, lambda x: printf('%.4f', CAST(CAST(x / norm AS FLOAT) AS DOUBLE))), ',') AS vec FROM n"""
STATEMENTS["parse_relevant_list"] = """
    SELECT CAST(doc_id AS VARCHAR) AS pmid, CAST(doc_id AS VARCHAR) || ',' || source AS relevant,
           CAST(n_chars + 9007199254740993 AS VARCHAR) AS numeric FROM documents"""
_UP = "translate(coalesce(text, ''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
STATEMENTS["markers_limit"] = f"""
    WITH u AS (SELECT CAST(doc_id AS VARCHAR) AS pmid, {_UP} AS t FROM documents), m AS (SELECT pmid, {S.evidence_markers('t')} AS m FROM u)
    SELECT pmid, array_to_string(m, ',') AS markers, CAST(len(m) AS INTEGER) AS n_markers FROM m"""
STATEMENTS["ingest_filter_gaps"] = with_(S.PAGES.replace("FROM pages)", """FROM (
    SELECT page_id, CASE WHEN page_id % 7 <> 0 THEN url ELSE 'http://example.org/about' END AS url,
           CASE WHEN page_id % 10 <> 0 THEN html END AS html FROM pages) g)""")) + "SELECT page_id, pmid, title, abstract FROM nonempty"
STATEMENTS["ingest_cascade_level"] = (CASCADE + "SELECT level, query_used, n_matched FROM chosen").replace(
    "  FROM articles)", """  FROM (SELECT pmid, title, CASE WHEN CAST(pmid AS BIGINT) % 97 = 0 THEN abstract || ' A biomarker of cancer.'
                              ELSE abstract END AS abstract FROM articles) a)""")
STATEMENTS["ingest_head_n"] = CASCADE + f"SELECT DISTINCT pmid FROM hay WHERE CASE (SELECT level FROM chosen) {_case} END ORDER BY pmid LIMIT 5"
STATEMENTS["ingest_xml_files"] = with_(ARTICLES) + "SELECT pmid, title, abstract FROM articles WHERE title <> '' OR abstract <> ''"

# Free query texts: predicates written out by hand beside the texts.
_TITLE, _ABSTRACT = "split_part(hay, '|', 1)", "split_part(hay, '|', 2)"
FREE = [
    ('(license[Title/Abstract] OR "apache license"[Abstract] OR warranty[Abstract]) NOT "mit license"[Title/Abstract]',
     f"({_T('license')} OR contains({_ABSTRACT}, ' apache license ') OR contains({_ABSTRACT}, ' warranty ')) AND NOT {_T('mit license')}"),
    ("license[Title]", f"contains({_TITLE}, ' license ')"),
    ("license[Abstract] NOT license[Title]", f"contains({_ABSTRACT}, ' license ') AND NOT contains({_TITLE}, ' license ')"),
    ('the OR of[Title] AND (license OR "free software")',
     f"({_T('the')} OR contains({_TITLE}, ' of ')) AND ({_T('license')} OR {_T('free software')})"),
    ('"as is" warranty', f"{_T('as is')} AND {_T('warranty')}"),
]
STATEMENTS["ingest_free_query"] = with_(ARTICLES, S.HAY) + " UNION ALL ".join(
    f"SELECT {i} AS query, {S.sq(t)} AS text, count_if({p}) AS n FROM hay" for i, (t, p) in enumerate(FREE))


def _often(words: str, field: str) -> str:
    """Occurrences of words in a field, spaces doubled so that neighbours share none."""
    said = "  ".join(words.split())
    return f"(length(replace({field}, ' ', '  ')) - length(replace(replace({field}, ' ', '  '), ' {said} ', ''))) / {len(said) + 2}"


_SAID = [(_T("license"), f"2 * {_often('license', _TITLE)} + {_often('license', _ABSTRACT)}"),
         (f"contains({_ABSTRACT}, ' apache license ')", _often("apache license", _ABSTRACT)),
         (f"contains({_ABSTRACT}, ' warranty ')", _often("warranty", _ABSTRACT))]
STATEMENTS["ingest_relevance"] = with_(
    ARTICLES, S.HAY,
    f"sized AS (SELECT pmid, hay, length(hay) - length(replace(hay, ' ', '')) - 2 AS size, {FREE[0][1]} AS fits, "
    + ", ".join(f"{t} AS tf{i}" for i, (_, t) in enumerate(_SAID)) + " FROM hay)",
    "stats AS (SELECT count(*) AS rows, avg(length(hay) - length(replace(hay, ' ', '')) - 2) AS mean, "
    + ", ".join(f"count_if({p}) AS n{i}" for i, (p, _) in enumerate(_SAID)) + " FROM hay)",
    "scored AS (SELECT pmid, round(" + " + ".join(
        f"ln(1 + (rows - n{i} + 0.5) / (n{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * size / mean))" for i in range(len(_SAID)))
    + ", 6) AS score FROM sized, stats WHERE fits)") + """
SELECT pmid, max(score) AS score FROM scored GROUP BY pmid ORDER BY score DESC, pmid LIMIT 50"""
