"""DuckDB oracle statements, one per registered query.

Each statement recomputes its result from the raw tables with plain SQL, so
the driver's side-by-side check compares two independent implementations.
Shared steps are CTE fragments assembled below.  DuckDB notes: RE2 regexes
(no lookaround: split-after-punctuation is done by inserting chr(1)); lists
are 1-based; ``lambda x: …`` syntax; ``chr(10)`` for a newline.
"""
from __future__ import annotations

NL = "chr(10)"
# Whitespace of str.strip(), as characters and as the inside of a regex class.
WS = "(" + " || ".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288)) + ")"
WSR = ("\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


ARTICLES = f"""
articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS pmid,
         {strip("regexp_extract(coalesce(text, ''), '^[^.!?\\n]*[.!?]?', 0)")} AS title,
         {strip("substring(coalesce(text, ''), length(regexp_extract(coalesce(text, ''), '^[^.!?\\n]*[.!?]?', 0)) + 1)")} AS abstract
  FROM documents)"""


def silver(n: int = 140, seed: int = 13, thr: str = "4ccccccc") -> str:
    return f"""
silver_pick AS (
  SELECT pmid, title, md5('{seed}|' || pmid) AS skey,
         regexp_extract_all(title, '[A-Za-z0-9\\-]+') AS toks
  FROM articles ORDER BY skey, pmid LIMIT {n}),
silver_keep AS (
  SELECT *, list_filter(toks, lambda t, i: substr(md5('{seed}|' || pmid || '|' || CAST(i - 1 AS VARCHAR)), 1, 8) > '{thr}') AS keep
  FROM silver_pick),
silver AS (
  SELECT printf('q%03d', row_number() OVER (ORDER BY skey, pmid) - 1) AS qid,
         CASE WHEN len(toks) >= 8
              THEN array_to_string(CASE WHEN len(keep) < 4 THEN toks[1:6] ELSE keep END, ' ')
              ELSE {strip("title")} END AS question,
         pmid AS relevant_pmids
  FROM silver_keep)"""


DOC_TEXT = strip(f"'PMID: ' || pmid || {NL} || 'TITLE: ' || title || {NL} || 'ABSTRACT: ' || abstract")

LEXICAL = f"""
doc_terms AS (
  SELECT pmid, lower(unnest(regexp_extract_all({DOC_TEXT}, '[A-Za-z0-9]+'))) AS term FROM articles),
tf AS (SELECT pmid, term, count(*) AS tf FROM doc_terms GROUP BY pmid, term),
vocab AS (
  SELECT term, ln(((SELECT count(*) FROM articles) + 1) / (count(*) + 1)) + 1 AS idf
  FROM tf GROUP BY term),
postings AS (
  SELECT pmid, term, w / sqrt(sum(w * w) OVER (PARTITION BY pmid)) AS w
  FROM (SELECT pmid, term, tf * idf AS w FROM tf JOIN vocab USING (term)))"""


def lexical_search(k: int = 5, questions: str = "silver") -> str:
    return f"""
q_terms AS (
  SELECT qid, lower(unnest(regexp_extract_all(question, '[A-Za-z0-9]+'))) AS term FROM {questions}),
q_tf AS (SELECT qid, term, count(*) AS tf FROM q_terms GROUP BY qid, term),
q_vec AS (
  SELECT qid, term, w / sqrt(sum(w * w) OVER (PARTITION BY qid)) AS qw
  FROM (SELECT qid, term, tf * idf AS w FROM q_tf JOIN vocab USING (term))),
scored AS (
  SELECT qid, pmid, max(score) AS score FROM (
    SELECT qid, pmid, round(sum(qw * w), 6) AS score FROM q_vec JOIN postings USING (term) GROUP BY qid, pmid
    UNION ALL SELECT qid, pmid, 0.0 FROM {questions}, (SELECT pmid FROM articles ORDER BY pmid LIMIT {k}) f)
  GROUP BY qid, pmid),
top AS (
  SELECT * FROM (
    SELECT qid, pmid, score,
           CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, pmid) AS INTEGER) AS rank
    FROM scored) WHERE rank <= {k}),
hits AS (
  SELECT qid, rank, pmid, title, abstract, score FROM top JOIN articles USING (pmid))"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def retrieval_prefix(k: int = 5) -> str:
    return with_(ARTICLES, silver(), LEXICAL, lexical_search(k))


# ------------------------------------------------------------------ evidence

QH = """
qh AS (
  SELECT qid, list(struct_pack(rank := rank, pmid := pmid, title := title, abstract := abstract, score := score)
                   ORDER BY rank) AS hits,
         string_agg(title || chr(10) || abstract, chr(10) ORDER BY rank) AS evidence
  FROM hits GROUP BY qid)"""

# Stop tokens.
STOP = ("['DNA','RNA','GEO','TCGA','PCA','SVM','ML','AI','US','BP','MP','NCT','PC4','FLEX',"
        "'I','II','III','IV','V','VI','I-III','I-II','II-III','I-IV','ER']")


def marker_tokens(x: str) -> str:
    cand = (f"regexp_extract_all(regexp_replace(coalesce({x}, ''), '[^\\x00-\\x7F\\PL]|[^\\x00-\\x7F\\PN]', 'a', 'g'), "
            f"'\\b[A-Z][A-Z0-9\\-]{{1,9}}\\b')")
    cleaned = (f"list_filter({cand}, lambda t: NOT list_contains({STOP}, t) AND NOT regexp_full_match(t, '[IVX\\-]+') "
               f"AND NOT ends_with(t, '-') AND NOT regexp_full_match(t, 'PC[0-9]+'))")
    return f"list_sort(list_distinct({cleaned}))"


def evidence_markers(x: str, n: int = 60) -> str:
    return f"list_slice({marker_tokens(x)}, 1, {n})"


def marker_blocks(markers: str, hits: str, k: int) -> str:
    return (f"list_transform({markers}, lambda m: struct_pack(marker := m, blocks := list_filter(list_transform({hits}, "
            f"lambda h: CASE WHEN contains(lower(h.title || chr(10) || h.abstract), lower(m)) AND h.rank BETWEEN 1 AND {k} "
            f"THEN h.rank END), lambda r: r IS NOT NULL)))")


def ints(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: coalesce(CAST(v AS VARCHAR), 'null')), ',')"


def snippet_head_tail(a: str, w: int = 650) -> str:
    return (f"CASE WHEN length({a}) > {w} THEN {strip(f'substring({a}, 1, {w}) || chr(10) || {chr(39)}...{chr(39)} || chr(10) || right({a}, {w})')} "
            f"ELSE {a} END")


def collapse_ws(a: str) -> str:
    return strip(f"regexp_replace({a}, '[{WSR}]+', ' ', 'g')")


def snippet_words(a: str, w: int = 550) -> str:
    s = collapse_ws(a)
    room = w - 1
    words = f"regexp_extract({s}, '(?s)^(.{{0,{room - 1}}}\\S) ', 1)"
    return (f"CASE WHEN length({s}) <= {w} THEN {s} ELSE "
            f"(CASE WHEN {words} = '' THEN substring({s}, 1, {room}) ELSE {words} END) || '…' END")


def context(hits: str, style: str = "head_tail") -> str:
    snip = snippet_head_tail("h.abstract") if style == "head_tail" else snippet_words("h.abstract")
    return (f"array_to_string(list_transform({hits}, lambda h: '[' || CAST(h.rank AS VARCHAR) || '] PMID ' || h.pmid || "
            f"' | ' || h.title || chr(10) || {snip}), chr(10) || chr(10))")


def evidence_ctx(k: int = 5, style: str = "head_tail", questions: str = "silver") -> str:
    return f"""
ctx AS (
  SELECT qh.qid, s.question, qh.hits, qh.evidence,
         {evidence_markers('qh.evidence')} AS markers,
         {context('qh.hits', style)} AS context
  FROM qh JOIN {questions} s USING (qid)),
ctx2 AS (SELECT *, {marker_blocks('markers', 'hits', k)} AS mblocks FROM ctx)"""


def sq(s: str) -> str:
    """A Python string as a DuckDB expression (newlines via chr(10))."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(lits) if len(lits) > 1 else lits[0]


def _template(template: str, fields: dict[str, str]) -> str:
    from citegrid.functions.compose import template_parts
    return " || ".join(fields[v] if kind == "field" else f"({sq(v)})" for kind, v in template_parts(template))


def prompt_strict(k: int = 5) -> str:
    from citegrid.functions.compose import STRICT_PROMPT
    return _template(STRICT_PROMPT, {
        "k": f"'{k}'", "question": "coalesce(question, '')", "context": "context",
        "markers": "CASE WHEN len(markers) > 0 THEN array_to_string(markers, ', ') ELSE '<none detected>' END"})


def prompt_simple() -> str:
    from citegrid.functions.compose import SIMPLE_PROMPT
    return _template(SIMPLE_PROMPT, {"question": "coalesce(question, '')", "context": "context"})


# ------------------------------------------------------------------- answers

def cite(b: str) -> str:
    return (f"CASE WHEN coalesce(len({b}), 0) <= 0 THEN '[1]' ELSE "
            f"array_to_string(list_transform({b}, lambda x: '[' || CAST(x AS VARCHAR) || ']'), '') END")


def compose(k: int = 5) -> str:
    """G6 over ctx2 columns (hits, mblocks)."""
    from citegrid.functions.compose import ComposerText
    t = ComposerText()
    top = "list_slice(list_filter(mblocks, lambda r: len(r.blocks) > 0), 1, 12)"
    cited = f"list_slice(list_sort(list_distinct(flatten(list_transform({top}, lambda r: r.blocks)))), 1, {k})"
    first = f"list_slice({cited}, 1, 1)"
    last = f"list_slice({cited}, -1, -1)"
    names = f"array_to_string(list_transform({top}, lambda r: r.marker), ', ')"
    bullets = (f"array_to_string(list_transform({top}, lambda r: '- ' || r.marker || ' ' || "
               f"{cite('r.blocks')} || chr(10)), '')")
    body = " || ".join([
        sq("Answer:\n"), sq(t.lead), cite(cited), "' '", sq(t.named), names, "'.'", cite(cited), "' '",
        sq(t.tail), cite(cited), "chr(10)", sq("\nBiomarkers mentioned in Evidence:\n"), bullets,
        sq("\nTakeaways:\n"), sq(t.take1), cite(first), "chr(10)", sq(t.take2), cite(cited), "chr(10)",
        sq(t.take3), cite(last), "chr(10)"])
    return f"CASE WHEN len({top}) = 0 THEN ({sq(t.none_answer)}) ELSE {body} END"


def mutate(a: str, qid: str = "qid", kind: str | None = None) -> str:
    kind = kind or f"(CAST(substring({qid}, 2, 10) AS INTEGER) % 8)"
    return f"""CASE {kind}
      WHEN 1 THEN {a} || chr(10) || 'References:' || chr(10) || '- none'
      WHEN 2 THEN replace({a}, '[1]', '[99]')
      WHEN 3 THEN regexp_replace({a}, '- Evidence also mentions[^\\n]*\\n', '', 'g')
      WHEN 4 THEN replace({a}, 'Answer:' || chr(10), 'Answer:' || chr(10) || 'ZZQX9 is cited [1]. ')
      WHEN 5 THEN regexp_replace({a}, '(Biomarkers mentioned in Evidence:\\n- [^\\n]*)', '\\1 [#]', 'g')
      WHEN 6 THEN replace(replace({a}, 'Answer:' || chr(10), ''), 'Takeaways:' || chr(10), '')
      WHEN 7 THEN replace(replace({a}, 'Answer:' || chr(10), chr(10) || 'answer :' || chr(10) || chr(10)),
                          'Takeaways:' || chr(10), 'takeaways:  ' || chr(10))
      ELSE {a} END"""


def normalize(a: str) -> str:
    t = strip(f"coalesce({a}, '')")
    # Header spellings and what they become.
    steps = [
        (f"(?im)^[{WSR}]*answer[{WSR}]*:[{WSR}]*$", "'Answer:'"),
        (f"(?im)^[{WSR}]*biomarkers[{WSR}]*:[{WSR}]*$", "'Biomarkers mentioned in Evidence:'"),
        (f"(?im)^[{WSR}]*biomarkers mentioned in evidence[{WSR}]*:[{WSR}]*$", "'Biomarkers mentioned in Evidence:'"),
        (f"(?im)^[{WSR}]*takeaways[{WSR}]*:[{WSR}]*$", "'Takeaways:'"),
        (f"(?im)^(Answer:)[{WSR}]*", "'\\1' || chr(10)"),
        (f"(?im)^(Biomarkers mentioned in Evidence:)[{WSR}]*", "'\\1' || chr(10)"),
        (f"(?im)^(Takeaways:)[{WSR}]*", "'\\1' || chr(10)"),
    ]
    for pat, rep in steps:
        t = f"regexp_replace({t}, '{pat}', {rep}, 'g')"
    return t


def section(a: str, start: str, end: str | None) -> str:
    if end is None:
        pat = f"(?ims)^{start}[{WSR}]*$[{WSR}]*(.*)$"
    else:
        pat = f"(?ims)^{start}[{WSR}]*$[{WSR}]*(.*?)^{end}[{WSR}]*$"
    return strip(f"regexp_extract({a}, '{pat}', 1)")


def ans_sec(a):
    return section(a, "Answer:", "Biomarkers mentioned in Evidence:")


def mark_sec(a):
    return section(a, "Biomarkers mentioned in Evidence:", "Takeaways:")


def take_sec(a):
    return section(a, "Takeaways:", None)


def citations(a: str) -> str:
    return f"list_transform(regexp_extract_all({a}, '\\[(\\d+)\\]', 1), lambda x: TRY_CAST(x AS BIGINT))"


def forall(lst: str, lam: str) -> str:
    return f"coalesce(list_bool_and(list_transform({lst}, {lam})), true)"


def in_range(c: str, k: int) -> str:
    return forall(c, f"lambda n: coalesce(n BETWEEN 1 AND {k}, false)")


def cites_in_range(a: str, k: int) -> str:
    return f"(len({citations(a)}) > 0 AND {in_range(citations(a), k)})"


def has_refs(a: str) -> str:
    return f"regexp_matches({a}, '(?im)^[{WSR}]*references[{WSR}]*:[{WSR}]*$')"


def not_relevant(a: str) -> str:
    return f"contains(lower({a}), 'not relevant')"


def present(a: str) -> str:
    return f"CAST(regexp_matches({a}, '\\[\\d+\\]') AS INTEGER)"


def sentences(sec: str) -> str:
    parts = f"string_split(regexp_replace({sec}, '([.?!])[{WSR}]+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({parts}, lambda s: {strip('s')}), lambda s: s <> '')"


def each_cited(sec: str) -> str:
    s = sentences(sec)
    return f"(len({s}) > 0 AND {forall(s, 'lambda x: regexp_matches(x, ' + chr(39) + '(\\[\\d+\\])+[' + WSR + ']*[.!?]?[' + WSR + ']*$' + chr(39) + ')')})"


LINE_BREAK = "\\r\\n|[\\n\\r\\x0B\\f\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]"


def bullets(sec: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({sec}, '{LINE_BREAK}'), lambda l: {strip('l')}), "
            f"lambda l: starts_with(l, '- '))")


def bullets_cited(b: str, k: int) -> str:
    return forall(b, f"lambda l: NOT contains(l, '[#]') AND len({citations('l')}) > 0 AND {in_range(citations('l'), k)}")


def leaked(a: str, ev: str) -> str:
    return f"list_filter({marker_tokens(a)}, lambda t: NOT contains(lower({ev}), lower(t)))"


def issues(a: str, ev: str, k: int) -> str:
    from citegrid.functions import rules as R
    mb = bullets(mark_sec(a))
    tb = bullets(take_sec(a))
    lk = leaked(a, ev)
    msgs = [
        f"CASE WHEN {has_refs(a)} THEN {sq(R.MSG_REFERENCES)} END",
        f"CASE WHEN {not_relevant(a)} THEN {sq(R.MSG_NOT_RELEVANT)} END",
        f"CASE WHEN NOT {cites_in_range(a, k)} THEN {sq(R.MSG_RANGE.format(k=k))} END",
        f"CASE WHEN NOT {each_cited(ans_sec(a))} THEN {sq(R.MSG_SENTENCES)} END",
        f"CASE WHEN len({mb}) = 0 THEN {sq(R.MSG_NO_MARKER_BULLETS)} WHEN NOT {bullets_cited(mb, k)} THEN {sq(R.MSG_MARKER_CITES)} END",
        f"CASE WHEN len({tb}) <> 3 THEN {sq(R.MSG_TAKEAWAY_COUNT)} WHEN NOT {bullets_cited(tb, k)} THEN {sq(R.MSG_TAKEAWAY_CITES)} END",
        f"CASE WHEN len({lk}) > 0 THEN {sq(R.MSG_LEAKED)} || array_to_string(list_slice({lk}, 1, 20), ', ') END",
    ]
    return f"list_filter([{', '.join(msgs)}], lambda m: m IS NOT NULL)"


# ----------------------------------------------------------------- ingestion

def markup_text(frag: str) -> str:
    nodes = f"regexp_split_to_array(coalesce({frag}, ''), '<[^>]*>')"
    dec = ("replace(replace(replace(replace(replace(replace(replace(n, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
           "'&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&')")
    return f"array_to_string(list_filter(list_transform({nodes}, lambda n: {strip(dec)}), lambda n: n <> ''), ' ')"


PAGES = f"""
pclean AS (
  SELECT page_id, url, regexp_replace(coalesce(html, ''), '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->', ' ', 'g') AS c
  FROM pages),
flat AS (
  SELECT page_id,
         CASE WHEN regexp_extract(url, '/([a-z]{{2}}/[0-9]+)', 1) <> '' THEN regexp_extract(url, '/([a-z]{{2}}/[0-9]+)', 1) END AS pmid,
         {markup_text("regexp_extract(c, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
         {markup_text("regexp_replace(regexp_extract(c, '(?is)<article[^>]*>(.*?)</article>', 1), '(?is)<h1[^>]*>.*?</h1>', ' ', 'g')")} AS abstract
  FROM pclean),
nonempty AS (SELECT * FROM flat WHERE pmid IS NOT NULL AND (title <> '' OR abstract <> ''))"""


def tiab(phrase: str) -> str:
    import re
    words = " ".join(w.lower() for w in re.findall(r"[A-Za-z0-9]+", phrase))
    return f"contains(hay, ' {words} ')"


HAY = f"""
hay AS (
  SELECT pmid, title, abstract,
         ' ' || array_to_string(list_transform(regexp_extract_all(title, '[A-Za-z0-9]+'), lambda t: lower(t)), ' ') || ' | ' ||
         array_to_string(list_transform(regexp_extract_all(abstract, '[A-Za-z0-9]+'), lambda t: lower(t)), ' ') || ' ' AS hay
  FROM articles)"""
