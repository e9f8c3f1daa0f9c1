"""Search text of a user as a predicate and a relevance over articles.

``breast cancer[Title] AND (biomarker OR "gene expression"[Title/Abstract])``:
phrases (quoted, or a run of words) with an optional field, joined by AND, OR
and NOT from left to right, brackets first; phrases side by side are joined by
AND.  A phrase matches where its words stand next to each other, as whole
words, in one of its fields.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Field tags, lower-cased, and the fields they stand for.
TAGS = {"title": ("title",), "ti": ("title",), "abstract": ("abstract",), "ab": ("abstract",),
        "title/abstract": ("title", "abstract"), "tiab": ("title", "abstract")}
ANY = TAGS["title/abstract"]
OPERATORS = ("AND", "OR", "NOT")
DEEPEST = 100
#: Relevance: weight of an occurrence by field, and the two saturation numbers.
WEIGHTS = {"title": 2.0, "abstract": 1.0}
K1, B = 1.2, 0.75

_PART = re.compile(r'\s*(?:"(?P<quote>[^"]*)"|\[(?P<tag>[^\]]*)\]|(?P<bracket>[()])|(?P<word>[^\s"()\[\]]+))')


@dataclass(frozen=True)
class Phrase:
    words: tuple[str, ...]
    fields: tuple[str, ...] = ANY


@dataclass(frozen=True)
class Both:
    operator: str
    left: Query
    right: Query


Query = Phrase | Both


class QueryError(ValueError):
    """Malformed search text; ``place`` counts characters from 0."""

    def __init__(self, message: str, place: int):
        super().__init__(f"{message} (at character {place})")
        self.place = place


def _parts(text: str) -> Iterator[tuple[str, str, int]]:
    at, end = 0, len(text.rstrip())
    while at < end:
        m = _PART.match(text, at)
        if m is None:
            raise QueryError("unclosed quotation mark or field", at + len(text[at:]) - len(text[at:].lstrip()))
        kind = m.lastgroup
        yield ("operator" if kind == "word" and m[kind] in OPERATORS else kind), m[kind], m.start(kind)
        at = m.end()
    yield "end", "", end


def read(text: str) -> Query:
    """The expression that the text stands for; raises ``QueryError``."""
    parts = list(_parts(text))
    at = 0

    def phrase() -> Phrase:
        nonlocal at
        kind, said, place = parts[at]
        at += 1
        while kind == "word" and parts[at][0] == "word":
            said += " " + parts[at][1]
            at += 1
        words = tuple(w.lower() for w in re.findall(r"[A-Za-z0-9]+", said))
        if not words:
            raise QueryError("phrase without a word", place)
        if parts[at][0] != "tag":
            return Phrase(words)
        _, tag, place = parts[at]
        at += 1
        if tag.strip().lower() not in TAGS:
            raise QueryError(f"unknown field [{tag}]", place)
        return Phrase(words, TAGS[tag.strip().lower()])

    def group(depth: int, opened: int) -> Query:
        nonlocal at
        if depth > DEEPEST:
            raise QueryError("brackets nested too deeply", opened)
        left, operator = None, None
        while True:
            kind, said, place = parts[at]
            if kind == "end" or (kind, said) == ("bracket", ")"):
                if kind == "end" and depth:
                    raise QueryError("bracket is not closed", opened)
                if kind != "end" and not depth:
                    raise QueryError("bracket closes nothing", place)
                if operator or left is None:
                    raise QueryError("phrase is missing", place)
                at += 1
                return left
            if kind == "operator":
                if left is None or operator:
                    raise QueryError(f"phrase is missing before {said}", place)
                operator = said
                at += 1
                continue
            if kind == "tag":
                raise QueryError("field without a phrase", place)
            if kind == "bracket":
                at += 1
                node = group(depth + 1, place)
            else:
                node = phrase()
            left = node if left is None else Both(operator or "AND", left, node)
            operator = None

    return group(0, 0)


# ------------------------------------------------------------ over the haystack column of ``cascade``

def _field(haystack: str, field: str) -> Column:
    """The words of one field, each between spaces."""
    return F.substring_index(haystack, "|", 1 if field == "title" else -1)


def predicate(query: Query, haystack: str) -> Column:
    if isinstance(query, Phrase):
        said = F.lit(f" {' '.join(query.words)} ")
        if query.fields == ANY:                  # the bar keeps a phrase inside one field
            return F.contains(F.col(haystack), said)
        return reduce(lambda a, b: a | b, (F.contains(_field(haystack, f), said) for f in query.fields))
    left, right = predicate(query.left, haystack), predicate(query.right, haystack)
    return {"AND": left & right, "OR": left | right, "NOT": left & ~right}[query.operator]


def wanted(query: Query) -> list[Phrase]:
    """Phrases that speak for an article, each once; what NOT takes away doesn't."""
    if isinstance(query, Phrase):
        return [query]
    found = wanted(query.left) + ([] if query.operator == "NOT" else wanted(query.right))
    return list(dict.fromkeys(found))


def occurrences(phrase: Phrase, haystack: str) -> Column:
    """Weighted number of occurrences (that don't overlap) in the phrase's fields."""
    said = "  ".join(phrase.words)
    total = F.lit(0.0)
    for field in phrase.fields:
        spread = F.replace(_field(haystack, field), F.lit(" "), F.lit("  "))      # neighbours share no space
        gone = F.length(spread) - F.length(F.replace(spread, F.lit(f" {said} "), F.lit("")))
        total = total + gone / F.lit(len(said) + 2) * WEIGHTS[field]
    return total


def _length(haystack: str) -> Column:
    return F.length(haystack) - F.length(F.replace(F.col(haystack), F.lit(" "), F.lit(""))) - 2


def relevance(articles: DataFrame, query: Query, haystack: str) -> DataFrame:
    """``(pmid, score)`` of the matching articles, an id once, at its best score.

    BM25 over phrases: ln(1 + (N - n + 0.5) / (n + 0.5)) times the saturated,
    length-normalised weighted occurrences.  N, the average length and each
    phrase's n come from one scan (one row); ranking is a second."""
    phrases = wanted(query)
    counts = articles.agg(F.count(F.lit(1)).alias("rows"), F.avg(_length(haystack)).alias("length"),
                          *[F.count_if(predicate(p, haystack)).alias(f"n_{i}") for i, p in enumerate(phrases)]).first()
    size = F.lit(1 - B) + F.lit(B / max(counts["length"] or 1.0, 1e-9)) * _length(haystack)
    total = F.lit(0.0)
    for i, p in enumerate(phrases):
        n, tf = counts[f"n_{i}"], occurrences(p, haystack)
        total = total + F.log(F.lit(1 + (counts["rows"] - n + 0.5) / (n + 0.5))) * tf * (K1 + 1) / (tf + K1 * size)
    found = articles.where(predicate(query, haystack)).select("pmid", F.round(total, 6).alias("score"))
    return found.groupBy("pmid").agg(F.max("score").alias("score"))
