"""Corpus search as predicates over an article table.

The reference sends a boolean title/abstract query to a search service and
falls back through progressively broader queries until one returns
anything.  Here a query is a Column predicate over the article table, read from
the query text (``level``) or built from ``tiab`` terms with ``&``/``|``.  All
levels are evaluated in **one scan** (one ``count_if`` per level); the first level
with a match wins, and its articles come in order of relevance.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.functions.text import nz
from citegrid.operators.lexical import terms
from citegrid.sources import querytext


HAYSTACK = "_tiab"


def with_haystack(articles: DataFrame) -> DataFrame:
    """Adds title and abstract as ' tok tok … | tok tok … ' (lower-case ASCII word
    tokens), computed once per row and shared by every level's predicate.  The
    bar, which no token has, keeps a phrase inside one of the two fields."""
    field = lambda c: F.array_join(terms(nz(F.col(c))), " ")
    return articles.withColumn(HAYSTACK, F.concat(F.lit(" "), field("title"), F.lit(" | "), field("abstract"), F.lit(" ")))


def tiab(phrase: str) -> Column:
    """``phrase[Title/Abstract]``: the phrase's words, consecutive, as whole
    words of the title or abstract (case-insensitive)."""
    words = " ".join(w.lower() for w in re.findall(r"[A-Za-z0-9]+", phrase))
    return F.contains(F.col(HAYSTACK), F.lit(f" {words} "))


@dataclass(frozen=True)
class Level:
    name: str          # the query text, recorded as ``query_used``
    predicate: Column
    query: querytext.Query | None = None     # what relevance is counted on, where the level came from a text


def level(text: str) -> Level:
    """A level from its query text; raises ``querytext.QueryError`` where it is malformed."""
    query = querytext.read(text)
    return Level(text, querytext.predicate(query, HAYSTACK), query)


def dedup_levels(levels: list[Level]) -> list[Level]:
    """Drop repeated queries, keeping the first occurrence."""
    seen, out = set(), []
    for lv in levels:
        if lv.name not in seen:
            seen.add(lv.name)
            out.append(lv)
    return out


def reference_levels(base: Level | str | None = None) -> list[Level]:
    """The base query (a level or its text) followed by the fixed broader fallbacks."""
    # The query texts, broader from one to the next.
    fallbacks = [level(text) for text in (
        '(breast cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract] '
        'OR transcriptomic[Title/Abstract])',
        '(breast cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract])',
        '(cancer[Title/Abstract]) AND (biomarker[Title/Abstract] OR "gene expression"[Title/Abstract])',
        'biomarker[Title/Abstract] AND "gene expression"[Title/Abstract]',
        "cancer[Title/Abstract]",
    )]
    first = level(base) if isinstance(base, str) else base
    return dedup_levels(([first] if first else []) + fallbacks)


def level_counts(articles: DataFrame, levels: list[Level]) -> DataFrame:
    """One row: ``n_<i>`` = number of matching articles per level (one scan)."""
    return articles.agg(*[F.count_if(lv.predicate).alias(f"n_{i}") for i, lv in enumerate(levels)])


def choose_level(articles: DataFrame, levels: list[Level]) -> DataFrame:
    """S8 as a plan: ``(level, query_used, n_matched)`` of the first level with
    a match; no row when nothing matches."""
    counts = level_counts(with_haystack(articles), levels)
    entries = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(lv.name).alias("query_used"),
                                 F.col(f"n_{i}").alias("n_matched")) for i, lv in enumerate(levels)])
    return counts.select(F.explode(F.filter(entries, lambda e: e["n_matched"] > 0)).alias("e")) \
        .select("e.*").orderBy("level").limit(1)


def search(articles: DataFrame, levels: list[Level], n_docs: int,
           order: list[str] | None = None) -> tuple[DataFrame, str]:
    """S1 + S8 + S9: ids of the first matching level, first ``n_docs`` by
    relevance (ties: by pmid), or by ``order`` where it is given; a level
    without a query text has no relevance and goes by pmid.  Raises when no
    level matches.  The winning level is a one-row result (a bounded scalar
    read by the driver)."""
    chosen = choose_level(articles, levels).first()
    if chosen is None:
        raise ValueError("No article matched any query level; try a simpler query.")
    lv = levels[chosen["level"]]
    found = with_haystack(articles).where(lv.predicate)
    if lv.query is not None and not order:
        ids = querytext.relevance(with_haystack(articles), lv.query, HAYSTACK).orderBy(F.desc("score"), "pmid")
    elif order:                                       # an id that repeats counts once, at its first place
        ids = found.groupBy("pmid").agg(F.min(F.struct(*order)).alias("place")).orderBy("place", "pmid")
    else:
        ids = found.select("pmid").distinct().orderBy("pmid")
    return ids.limit(n_docs).select("pmid"), lv.name
