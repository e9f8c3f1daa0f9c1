"""Top-k per question (R2, R3) and the hit table."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def top_k(scored: DataFrame, k: int, group: str = "qid", item: str = "pmid",
          score: str = "score", digits: int = SCORE_DIGITS) -> DataFrame:
    """Keep the k best ``item`` per ``group`` by score (rounded to ``digits`` so
    ties are decided by the item id, identically in every engine) and number
    them 1..k.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle on ``group``, so a question with millions of
    candidates still moves only k rows per map partition.
    """
    rounded = scored.withColumn(score, F.round(F.col(score), digits))
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(item).asc())
    return (rounded.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


class BestSoFar:
    """Exactly the k best (score descending, id ascending) of each query among
    the score blocks seen so far.  Scores are rounded here, so the order inside
    a task is the order of ``top_k`` and no tie needs more than k rows.  Once a
    query has k rows, only scores that reach its kth one are looked at."""

    def __init__(self, k: int):
        self.k = k
        self.q = np.zeros(0, np.int64)
        self.d = None
        self.s = np.zeros(0)
        self.kth = np.zeros(0)

    def add(self, scores: np.ndarray, ids: np.ndarray, first: int = 0, positive: bool = False) -> None:
        """``scores`` (queries × documents; -inf marks no candidate, or with
        ``positive`` any score that is not above 0) of the queries from
        ``first`` on."""
        if scores.size == 0:
            return
        if len(self.kth) < first + len(scores):
            self.kth = np.concatenate([self.kth, np.full(first + len(scores) - len(self.kth), -np.inf)])
        floor = self.kth[first:first + len(scores)]
        least = floor - 10.0 ** -SCORE_DIGITS                                # rounding may lift a score by half a digit
        near = scores >= (np.maximum(least, np.nextafter(0, 1)) if positive else least)[:, None]
        if np.count_nonzero(near) > 4 * self.k * len(scores):
            if positive:
                scores = np.where(near, scores, -np.inf)
            scores = np.round(scores, SCORE_DIGITS)
            if scores.shape[1] > self.k:
                floor = np.maximum(floor, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
            near = scores >= floor[:, None]
        if near.flags.f_contiguous:
            cols, rows = np.divmod(np.flatnonzero(near.T), len(scores))
        else:
            rows, cols = np.divmod(np.flatnonzero(near), scores.shape[1])
        real = np.isfinite(scores[rows, cols])
        rows, cols = rows[real], cols[real]
        if len(rows):
            self._merge(rows + first, ids[cols], np.round(scores[rows, cols], SCORE_DIGITS))

    def _merge(self, q: np.ndarray, d: np.ndarray, s: np.ndarray) -> None:
        touched = np.zeros(len(self.kth), bool)
        touched[q] = True
        old = touched[self.q]                                                # queries that get nothing stay as they are
        rest = (self.q[~old], self.d[~old], self.s[~old]) if self.d is not None else None
        q, s = np.concatenate([self.q[old], q]), np.concatenate([self.s[old], s])
        d = d if self.d is None else np.concatenate([self.d[old], d])
        place = np.unique(d, return_inverse=True)[1] if d.dtype == object else d
        order = np.lexsort((place, -s, q))
        q, d, s = q[order], d[order], s[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q, "left")
        full = nth == self.k - 1
        self.kth[q[full]] = s[full]
        keep = nth < self.k
        own = q[keep], d[keep], s[keep]
        self.q, self.d, self.s = own if rest is None else (np.concatenate(x) for x in zip(rest, own))

    def ids(self) -> list:
        return [] if self.d is None else self.d.tolist()


def hits_with_docs(top: DataFrame, articles: DataFrame) -> DataFrame:
    """Attach title/abstract to the ranked ids (by key, never by position).
    Documents are fetched after the top-k, never before; Spark picks the join
    from measured sizes."""
    docs = articles.select("pmid", "title", "abstract")
    return (top.join(docs, "pmid", "inner")
            .select("qid", F.col("rank").cast("int").alias("rank"), "pmid", "title", "abstract",
                    F.col("score").cast("double").alias("score")))


def hit_arrays(hits: DataFrame, group: str = "qid") -> DataFrame:
    """One row per question with its rank-sorted ``hits`` array (k elements)."""
    return hits.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(
        "rank", "pmid", "title", "abstract", "score"))).alias("hits"))


def with_hits(questions: DataFrame, arrays: DataFrame) -> DataFrame:
    """Every question with its hits; an empty array where it has none."""
    return questions.join(arrays, "qid", "left").withColumn("hits", F.coalesce("hits", F.array().cast(arrays.schema["hits"].dataType)))
