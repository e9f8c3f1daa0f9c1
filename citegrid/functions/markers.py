"""Marker-token (gene-like symbol) extraction as Column expressions.

Word boundaries: Python's ``\\b`` treats every Unicode letter or digit as a
word character.  To get that rule from any regex engine (Java 17, newer JDKs,
or ASCII-only engines) we first map each non-ASCII letter/digit to ``a``, a
word character that can never start or extend a token.  Tokens are pure ASCII,
so their text is unchanged.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citegrid.functions.text import col, nz

# Token shape, stop tokens and the cleanup patterns.
MARKER_PATTERN = r"\b[A-Z][A-Z0-9\-]{1,9}\b"
STOP_TOKENS = [
    "DNA", "RNA", "GEO", "TCGA", "PCA", "SVM", "ML", "AI", "US",
    "BP", "MP", "NCT", "PC4", "FLEX",
    "I", "II", "III", "IV", "V", "VI",
    "I-III", "I-II", "II-III", "I-IV",
    "ER",
]
ROMAN_PATTERN = r"^[IVX\-]+$"
PC_PATTERN = r"^PC[0-9]+$"
MAX_MARKERS = 60

_NON_ASCII_WORD = r"[\p{L}\p{N}&&[^\x00-\x7F]]"


def word_safe(text: Column | str) -> Column:
    return F.regexp_replace(nz(text), _NON_ASCII_WORD, "a")


def candidates(text: Column | str) -> Column:
    """Every token-shaped match, in text order, with repeats."""
    return F.regexp_extract_all(word_safe(text), F.lit(MARKER_PATTERN), 0)


def clean(tokens: Column) -> Column:
    """Drop stop tokens, roman-numeral shapes, trailing hyphens, PC<n>."""
    stop = F.array(*[F.lit(s) for s in STOP_TOKENS])
    return F.filter(tokens, lambda t: ~F.array_contains(stop, t)
                    & ~t.rlike(ROMAN_PATTERN)
                    & ~t.endswith("-")
                    & ~t.rlike(PC_PATTERN))


def marker_tokens(text: Column | str) -> Column:
    """Cleaned, distinct, sorted tokens of ``text``."""
    return F.array_sort(F.array_distinct(clean(candidates(text))))


def evidence_markers(evidence: Column | str, limit: int = MAX_MARKERS) -> Column:
    """The first ``limit`` markers, alphabetically."""
    return F.slice(marker_tokens(evidence), 1, limit)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once per row however often the
    lambdas inside use it (an outer expression inside a lambda is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def leaked_tokens(answer: Column | str, evidence: Column | str) -> Column:
    """V7: marker tokens of the answer not found (case-insensitive substring) in
    the evidence text."""
    tokens = marker_tokens(answer)
    return _let(F.lower(nz(evidence)), lambda ev: F.filter(tokens, lambda t: ~F.contains(ev, F.lower(t))))


def token_runs(text: Column | str) -> Column:
    """The distinct runs of token characters of a lowered text, one per line.  A
    token holds no other characters, so it is a substring of the lowered text
    just when it is one of these runs: ``leaked_tokens`` is the same on both."""
    return F.array_join(F.array_distinct(F.regexp_extract_all(F.lower(nz(text)), F.lit("[a-z0-9\\-]+"), 0)), "\n")


def marker_blocks(markers: Column, hits: Column, k: Column | int, whole_word: bool = False) -> Column:
    """For each marker, the ranks (1..k, hit order, distinct) of the hits
    whose ``title\nabstract`` contains it, ignoring case.

    Matching is by substring, as in the reference (``AR`` matches "are");
    ``whole_word=True`` requires the marker not to touch another letter or
    digit on either side.  ``hits`` is the rank-sorted
    ``array<struct<rank,title,abstract,…>>`` of one question, so this is
    bounded per row (k hits × ≤60 markers): no join.  Each hit's text is lowered
    once, not once per marker.
    """
    kk = F.lit(k) if isinstance(k, int) else col(k)

    def text(h: Column) -> Column:
        blob = F.concat(nz(h["title"]), F.lit("\n"), nz(h["abstract"]))
        return blob if whole_word else F.lower(blob)

    def found(blob: Column, m: Column) -> Column:
        if not whole_word:
            return F.contains(blob, F.lower(m))
        pattern = F.concat(F.lit(r"(?i)(?<![\p{L}\p{N}])\Q"), m, F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.rlike(blob, pattern)

    def blocks_of(m: Column, texts: Column) -> Column:
        ranks = F.transform(texts, lambda h: F.when(found(h["text"], m) & (h["rank"] >= 1) & (h["rank"] <= kk), h["rank"]))
        return F.array_distinct(F.filter(ranks, lambda r: r.isNotNull()))

    texts = F.transform(hits, lambda h: F.struct(h["rank"].alias("rank"), text(h).alias("text")))
    return _let(texts, lambda ts: F.transform(markers, lambda m: F.struct(m.alias("marker"), blocks_of(m, ts).alias("blocks"))))
