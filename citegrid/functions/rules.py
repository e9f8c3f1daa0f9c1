"""Answer normalisation (G2) and the validation rule table.

Every rule is a Column expression over the answer text, the question's
evidence text and ``k``; a whole table of answers is validated in one
projection.  Regex flags: ``d`` (only ``\\n`` ends a line, as in Python), ``i``,
``m``, ``s``.  Citation numbers use ``try_cast`` so an absurd ``[99999999999]``
becomes null (= out of range) instead of failing the job under ANSI mode.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citegrid.functions import markers as M
from citegrid.functions.text import WS_CLASS, col, nz, strip

# Section headers and their accepted spellings.
H_ANSWER = "Answer:"
H_MARKERS = "Biomarkers mentioned in Evidence:"
H_TAKEAWAYS = "Takeaways:"

# Normalisation rewrites, applied in this order.
NORMALIZE_STEPS = [
    (rf"(?dim)^{WS_CLASS}*answer{WS_CLASS}*:{WS_CLASS}*$", "Answer:"),
    (rf"(?dim)^{WS_CLASS}*biomarkers{WS_CLASS}*:{WS_CLASS}*$", "Biomarkers mentioned in Evidence:"),
    (rf"(?dim)^{WS_CLASS}*biomarkers mentioned in evidence{WS_CLASS}*:{WS_CLASS}*$", "Biomarkers mentioned in Evidence:"),
    (rf"(?dim)^{WS_CLASS}*takeaways{WS_CLASS}*:{WS_CLASS}*$", "Takeaways:"),
    (rf"(?dim)^(Answer:){WS_CLASS}*", "$1\n"),
    (rf"(?dim)^(Biomarkers mentioned in Evidence:){WS_CLASS}*", "$1\n"),
    (rf"(?dim)^(Takeaways:){WS_CLASS}*", "$1\n"),
]

# Issue messages, in report order.
MSG_REFERENCES = "Contains a 'References:' section (disallowed)."
MSG_NOT_RELEVANT = "Contains 'Not relevant' text (disallowed)."
MSG_RANGE = "Citations missing or out of range. Must cite only [1]..[{k}]."
MSG_SENTENCES = ("Every sentence in Answer must end with citation(s) like [1] or [1][3] "
                 "(period may come after).")
MSG_NO_MARKER_BULLETS = ("Biomarkers section must be bullet lines starting with '- ' "
                         "(no 'None' unless truly none).")
MSG_MARKER_CITES = ("Each biomarker bullet must include numeric citations like [4] (no [#]) "
                    "and be within range.")
MSG_TAKEAWAY_COUNT = "Takeaways must have exactly 3 bullet points starting with '- '."
MSG_TAKEAWAY_CITES = "Each takeaway bullet must include numeric citations like [1] and be within range."
MSG_LEAKED = "Mentions gene/biomarker-like tokens not found in evidence: "
MAX_LEAKED_IN_MESSAGE = 20
N_TAKEAWAYS = 3

# Fixed value: shape of a citation.
CITATION = r"\[(\d+)\]"
# Line breaks as str.splitlines() sees them.
LINE_BREAK = "\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"


def _k(k: Column | int) -> Column:
    return F.lit(k) if isinstance(k, int) else col(k)


def normalize(answer: Column | str) -> Column:
    """Canonical header spellings, each header followed by a newline."""
    t = strip(nz(answer))
    for pattern, repl in NORMALIZE_STEPS:
        t = F.regexp_replace(t, pattern, repl)
    return t


def section(answer: Column | str, start: str, end: str | None) -> Column:
    """V1: text between a header line and the next header line (lazy), or to
    the end when ``end`` is None; '' when the header is absent."""
    s = rf"^{_esc(start)}{WS_CLASS}*$"
    if end is None:
        pat = rf"(?dims){s}{WS_CLASS}*(.*)$"
    else:
        pat = rf"(?dims){s}{WS_CLASS}*(.*?)^{_esc(end)}{WS_CLASS}*$"
    return strip(F.regexp_extract(nz(answer), pat, 1))


def _esc(h: str) -> str:
    return h.replace("(", r"\(").replace(")", r"\)")


def answer_section(a):
    return section(a, H_ANSWER, H_MARKERS)


def marker_section(a):
    return section(a, H_MARKERS, H_TAKEAWAYS)


def takeaway_section(a):
    return section(a, H_TAKEAWAYS, None)


def citations(text: Column | str) -> Column:
    """V2: all ``[n]`` numbers in order (null when too large for a bigint)."""
    return F.transform(F.regexp_extract_all(nz(text), F.lit(CITATION), 1),
                       lambda x: x.try_cast("bigint"))


def _all_in_range(nums: Column, k: Column | int) -> Column:
    kk = _k(k)
    return F.forall(nums, lambda n: F.coalesce((n >= 1) & (n <= kk), F.lit(False)))


def has_references(text: Column | str) -> Column:
    """V3"""
    return nz(text).rlike(rf"(?dim)^{WS_CLASS}*references{WS_CLASS}*:{WS_CLASS}*$")


def has_not_relevant(text: Column | str) -> Column:
    """V4"""
    return F.contains(F.lower(nz(text)), F.lit("not relevant"))


def citations_in_range(text: Column | str, k: Column | int) -> Column:
    """V5: at least one citation and all within 1..k."""
    c = citations(text)
    return (F.size(c) > 0) & _all_in_range(c, k)


def citations_present(text: Column | str) -> Column:
    """V6 (0/1)"""
    return nz(text).rlike(r"\[\d+\]").cast("int")


def citations_valid(text: Column | str, k: Column | int) -> Column:
    """V5 as 0/1 (evaluation form)."""
    return citations_in_range(text, k).cast("int")


def sentences(section_text: Column | str) -> Column:
    """Sentences of a section: split after ``.``/``?``/``!`` + whitespace, stripped,
    empties dropped."""
    parts = F.split(nz(section_text), r"(?<=[.?!])" + WS_CLASS + "+", -1)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def each_sentence_cited(section_text: Column | str) -> Column:
    """V8: non-empty, and every sentence ends with citations (a final
    punctuation mark may follow)."""
    s = sentences(section_text)
    return (F.size(s) > 0) & F.forall(s, lambda x: x.rlike(rf"(\[\d+\])+{WS_CLASS}*[.!?]?{WS_CLASS}*$"))


def bullets(section_text: Column | str) -> Column:
    """V9: stripped lines that start with ``- ``."""
    lines = F.transform(F.split(nz(section_text), LINE_BREAK, -1), strip)
    return F.filter(lines, lambda ln: ln.startswith("- "))


def bullets_cited(lines: Column, k: Column | int) -> Column:
    """Every bullet has ≥1 numeric citation, all in range, and no ``[#]``."""
    return F.forall(lines, lambda ln: ~F.contains(ln, F.lit("[#]"))
                    & (F.size(citations(ln)) > 0)
                    & _all_in_range(citations(ln), k))


def issues(answer: Column | str, evidence: Column | str, k: Column | int,
           leaked: Column | None = None) -> Column:
    """The ordered list of rule messages (empty list = ok)."""
    a = nz(answer)
    kk = _k(k)
    mb = bullets(marker_section(a))
    tb = bullets(takeaway_section(a))
    leaked = M.leaked_tokens(a, evidence) if leaked is None else leaked
    msgs = [
        F.when(has_references(a), F.lit(MSG_REFERENCES)),
        F.when(has_not_relevant(a), F.lit(MSG_NOT_RELEVANT)),
        F.when(~citations_in_range(a, kk),
               F.concat(F.lit(MSG_RANGE.split("{k}")[0]), kk.cast("string"), F.lit(MSG_RANGE.split("{k}")[1]))),
        F.when(~each_sentence_cited(answer_section(a)), F.lit(MSG_SENTENCES)),
        F.when(F.size(mb) == 0, F.lit(MSG_NO_MARKER_BULLETS))
         .when(~bullets_cited(mb, kk), F.lit(MSG_MARKER_CITES)),
        F.when(F.size(tb) != N_TAKEAWAYS, F.lit(MSG_TAKEAWAY_COUNT))
         .when(~bullets_cited(tb, kk), F.lit(MSG_TAKEAWAY_CITES)),
        F.when(F.size(leaked) > 0,
               F.concat(F.lit(MSG_LEAKED),
                        F.array_join(F.slice(leaked, 1, MAX_LEAKED_IN_MESSAGE), ", "))),
    ]
    return F.filter(F.array(*msgs), lambda m: m.isNotNull())


def validate(answer: Column | str, evidence: Column | str, k: Column | int,
             markers: Column | None = None, leaked: Column | None = None) -> Column:
    """V11 record: ``struct<ok, issues, leaked_tokens, citations,
    biomarkers_in_evidence>``.  ``markers``/``leaked`` may be passed as
    already-computed columns (see ``with_validation``)."""
    leaked = M.leaked_tokens(answer, evidence) if leaked is None else leaked
    iss = issues(answer, evidence, k, leaked)
    return F.struct(
        (F.size(iss) == 0).alias("ok"),
        iss.alias("issues"),
        leaked.alias("leaked_tokens"),
        citations(answer).alias("citations"),
        (M.evidence_markers(evidence) if markers is None else markers).alias("biomarkers_in_evidence"),
    )


def with_validation(df, answer: str = "answer", evidence: str = "evidence", k: Column | int = 5,
                    markers: str | None = "markers", out: str = "validation", leaked: str | None = None):
    """Adds the V11 record as column ``out``, computing the leaked tokens once
    in their own projection (Catalyst keeps a non-cheap expression that is
    used twice in a separate projection instead of duplicating it).  ``leaked``
    and ``markers`` may be columns that are there already
    (``evidence.with_leaked``); then no evidence is read."""
    mk = F.col(markers) if markers and markers in df.columns else None
    if leaked:
        return df.withColumn(out, validate(F.col(answer), F.lit(None).cast("string"), k, mk, F.col(leaked)))
    d = df.withColumn("_leaked", M.leaked_tokens(F.col(answer), F.col(evidence)))
    return d.withColumn(out, validate(F.col(answer), F.col(evidence), k, mk, F.col("_leaked"))).drop("_leaked")
