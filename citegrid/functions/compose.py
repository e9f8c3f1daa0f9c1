"""Per-question text assembly over a rank-sorted hit array.

``hits`` below is one question's ``array<struct<rank,pmid,title,abstract,score>>``
sorted by rank; it holds at most k elements, so everything here is a bounded
per-row projection.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from citegrid.functions import markers as M
from citegrid.functions.text import col, nz, snippet_head_tail, snippet_words


def evidence_text(hits: Column) -> Column:
    """Titles and abstracts of all hits in rank order, one per line."""
    return F.array_join(F.flatten(F.transform(
        hits, lambda h: F.array(nz(h["title"]), nz(h["abstract"])))), "\n")


def cite(blocks: Column) -> Column:
    """``[b1][b2]…``, or ``[1]`` for no blocks."""
    return F.when(F.coalesce(F.size(blocks), F.lit(0)) <= 0, F.lit("[1]")).otherwise(
        F.array_join(F.transform(blocks, lambda b: F.concat(F.lit("["), b.cast("string"), F.lit("]"))), ""))


def snippet(abstract: Column | str, style: str = "head_tail") -> Column:
    """``head_tail`` (E8, answering) or ``words`` (E9, eval)."""
    return (snippet_head_tail if style == "head_tail" else snippet_words)(abstract)


def context_blocks(hits: Column, style: str | None = "head_tail") -> Column:
    """``[rank] PMID id | title\\nsnippet`` per hit, blank line between.
    ``style`` picks the snippet; None: the hits carry theirs, not the abstract."""
    return F.array_join(F.transform(hits, lambda h: F.concat(
        F.lit("["), h["rank"].cast("string"), F.lit("] PMID "), nz(h["pmid"]), F.lit(" | "),
        nz(h["title"]), F.lit("\n"), snippet(h["abstract"], style) if style else h["snippet"])), "\n\n")


# The strict prompt (answering path); {names} are filled per question.
STRICT_PROMPT = """You are a biomedical research assistant.

HARD RULES:
- Use ONLY the Evidence provided. No outside knowledge.
- Do NOT write a References section.
- Do NOT use placeholders like [#]. Use numeric citations only, like [4].
- Evidence blocks are numbered [1]..[{k}]. Only cite within [1]..[{k}].

OUTPUT FORMAT (MUST match EXACTLY; do not rename headers):
Answer:
<3–6 sentences. EVERY sentence ends with citations like [1] or [1][3]. Period may come after citations.>

Biomarkers mentioned in Evidence:
- <biomarker> [n]
- <biomarker> [n]
(List ONLY biomarkers explicitly present in Evidence. If none exist, write: - None [1])

Takeaways:
- <takeaway> [n]
- <takeaway> [n]
- <takeaway> [n]
(Exactly 3 bullet points, each includes numeric citations.)

Question: {question}

Biomarkers detected in Evidence (do NOT go beyond this set when listing biomarkers):
{markers}

Evidence:
{context}
"""

# The simple prompt (evaluation path).
SIMPLE_PROMPT = """You are a biomedical research assistant.
Answer the question using ONLY the provided evidence.
If evidence is insufficient, say so.
Cite sources like [1], [2] matching the evidence blocks.

Question: {question}

Evidence:
{context}
"""

NO_MARKERS = "<none detected>"
_FIELD = re.compile(r"\{(k|question|markers|context|prompt|issues)\}")


def template_parts(template: str) -> list[tuple[str, str]]:
    """A template as ``(kind, value)`` parts in order: ``("text", …)`` or
    ``("field", name)``."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(("text", template[pos:m.start()]))
        parts.append(("field", m.group(1)))
        pos = m.end()
    if pos < len(template):
        parts.append(("text", template[pos:]))
    return parts


def _fill(template: str, fields: dict[str, Column]) -> Column:
    return F.concat(*[fields[v] if kind == "field" else F.lit(v) for kind, v in template_parts(template)])


def prompt_strict(question: Column | str, context: Column, markers: Column, k: Column | int) -> Column:
    """The strict prompt; ``<none detected>`` when there is no marker."""
    kk = (F.lit(k) if isinstance(k, int) else col(k)).cast("string")
    mline = F.when(F.size(markers) > 0, F.array_join(markers, ", ")).otherwise(F.lit(NO_MARKERS))
    return _fill(STRICT_PROMPT, {"k": kk, "question": nz(question), "markers": mline, "context": context})


def prompt_simple(question: Column | str, context: Column) -> Column:
    """The evaluation prompt."""
    return _fill(SIMPLE_PROMPT, {"question": nz(question), "context": context})


# The retry prompt (the original prompt, the issues, the format reminder).
RETRY_PROMPT = """{prompt}

Your previous answer violated the rules:
{issues}

Rewrite it and FOLLOW THE FORMAT EXACTLY (headers must match):
Answer:
...
Biomarkers mentioned in Evidence:
- ...
Takeaways:
- ...
- ...
- ...

Remember:
- Biomarker lines MUST start with "- " and must have numeric citations.
- Every Answer sentence MUST end with citations.
- Takeaways MUST be exactly 3 bullet lines starting with "- ".
"""


def retry_prompt(prompt: Column | str, issue_list: Column) -> Column:
    """The original prompt plus the issue list and the format reminder."""
    listed = F.array_join(F.transform(issue_list, lambda x: F.concat(F.lit("- "), x)), "\n")
    return _fill(RETRY_PROMPT, {"prompt": nz(prompt), "issues": listed})


# Default wording of the composed answer (the answer text only;
# every citation and marker name is taken from the evidence).
@dataclass(frozen=True)
class ComposerText:
    """Wording of the extractive answer (G6).  Only text; every citation and
    every marker name comes from the evidence itself."""
    lead: str = ("Breast cancer subtype/classification in the retrieved evidence is discussed in the "
                 "context of gene expression profiling and molecular subtype designation.")
    named: str = "Specific transcriptomic biomarkers explicitly named in the evidence include "
    tail: str = ("These markers appear as differentially expressed genes or signature components "
                 "associated with distinct molecular subtypes and related clinical/risk analyses in "
                 "the retrieved studies.")
    take1: str = ("- Evidence explicitly names subtype-associated genes (e.g., oxidative "
                  "stress/autophagy-related markers) across molecular subtypes.")
    take2: str = ("- Evidence includes prognostic/risk-oriented transcriptomic analyses and subtype "
                  "designation using gene expression data.")
    take3: str = ("- Evidence also mentions proteins tied to recurrence-risk discrimination that "
                  "originate from transcriptomic/proteomic integration work.")
    none_answer: str = (
        "Answer:\n"
        "The provided evidence does not explicitly list specific gene biomarkers for subtype "
        "classification for this query.[1]\n"
        "\nBiomarkers mentioned in Evidence:\n"
        "- None [1]\n"
        "\nTakeaways:\n"
        "- Evidence retrieved did not name specific subtype biomarkers for this query.[1]\n"
        "- Try expanding the corpus/query to include subtype signature papers (e.g., PAM50-related "
        "abstracts).[1]\n"
        "- More targeted retrieval is needed to extract explicit gene lists for subtype "
        "classification.[1]\n"
    )


MAX_COMPOSED_MARKERS = 12


def compose(hits: Column, k: Column | int, text: ComposerText = ComposerText(),
            mblocks: Column | None = None) -> Column:
    """A formatted answer built only from the evidence.

    Up to 12 markers (alphabetical), each bulleted with the blocks that contain
    it (``mblocks``: precomputed E7 rows, optional); the answer sentences and takeaways cite blocks that exist (the union
    of the listed markers' blocks, capped at k).  No marker -> the fixed
    "None" answer, which cites [1].
    """
    kk = F.lit(k) if isinstance(k, int) else col(k)
    if mblocks is None:
        mblocks = M.marker_blocks(M.evidence_markers(evidence_text(hits)), hits, kk)
    rows = F.filter(mblocks, lambda r: F.size(r["blocks"]) > 0)
    top = F.slice(rows, 1, MAX_COMPOSED_MARKERS)
    cited = F.slice(F.array_sort(F.array_distinct(F.flatten(F.transform(top, lambda r: r["blocks"])))), 1, kk)
    first = F.slice(cited, 1, 1)
    last = F.slice(cited, -1, 1)
    names = F.array_join(F.transform(top, lambda r: r["marker"]), ", ")
    answer = F.concat(
        F.lit("Answer:\n"),
        F.lit(text.lead), cite(cited), F.lit(" "),
        F.lit(text.named), names, F.lit("."), cite(cited), F.lit(" "),
        F.lit(text.tail), cite(cited), F.lit("\n"),
        F.lit("\nBiomarkers mentioned in Evidence:\n"),
        F.array_join(F.transform(top, lambda r: F.concat(F.lit("- "), r["marker"], F.lit(" "),
                                                         cite(r["blocks"]), F.lit("\n"))), ""),
        F.lit("\nTakeaways:\n"),
        F.lit(text.take1), cite(first), F.lit("\n"),
        F.lit(text.take2), cite(cited), F.lit("\n"),
        F.lit(text.take3), cite(last), F.lit("\n"),
    )
    return F.when(F.size(top) == 0, F.lit(text.none_answer)).otherwise(answer)
