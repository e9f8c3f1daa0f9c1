"""Toxicity by nearest labelled examples.

A bounded sample of labelled documents is indexed by TF-IDF weights over the
terms that tell the labels apart.  Every document is a query: its nearest
examples by exact cosine come from a block-max inverted index, their labels
vote with weights that fall with distance, and the vote is calibrated on the
examples themselves, each judged by the others.  Document frequencies are
counted over all documents.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm.textbatch import ALNUM, flat, mix64, slices, span_hashes
from citegrid.session import ship_package

#: Labelled examples of each label that are sampled at most (the bound of the fitted sample).
EXAMPLES = 1500
#: Terms kept at most, and the least association (z value) and number of examples of a term.
TERMS, LEAST_Z, LEAST_EXAMPLES = 2048, 4.0, 3
#: Terms are words and their first bytes, so many of them; and each again when it occurs so often.
BEGINNINGS = (4, 5, 6, 7)
TIERS = (1, 2, 3, 5, 8)
NEIGHBOURS = 9
#: Examples per block of the index.
BLOCK = 64
#: Added to a distance before it is inverted; bounds the weight of one vote.
SOFTEN = 0.05
THRESHOLD = 0.3


def tiered(terms: np.ndarray, tier: int) -> np.ndarray:
    """Hash of "the term occurs ``tier`` times or more"."""
    return mix64(terms + np.uint64(tier))


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the values in a sorted table, -1 where they are not in it."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def terms_of(rows: pa.RecordBatch, quick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every term of the texts; with ``quick`` only of those
    whose low 20 bits it has."""
    data, offsets = flat(rows.column("text"))
    got_row, got = [], []
    for place, hashes in span_hashes(data, offsets, ALNUM, BEGINNINGS):
        if quick is not None:
            keep = quick[(hashes & np.uint64(0xFFFFF)).astype(np.int64)]
            place, hashes = place[keep], hashes[keep]
        got_row.append(np.searchsorted(offsets, place, "right") - 1)
        got.append(hashes)
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(got_row), np.concatenate(got)


@dataclass
class Index:
    """terms: sorted hashes of tiered terms; plain: sorted hashes of the terms; idf per tiered term; weights: (block, term, place) with
    examples as columns of unit length; most: (term, block) largest weight of
    the block; ids, labels, worth (class weight) per example; floor: calibrated
    score of a document that has no term; steps, scores: calibration."""
    terms: np.ndarray
    plain: np.ndarray
    idf: np.ndarray
    weights: np.ndarray
    most: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    worth: np.ndarray
    floor: float
    steps: np.ndarray
    scores: np.ndarray

    def __post_init__(self):
        self.quick = np.zeros(1 << 20, bool)
        self.quick[(self.plain & np.uint64(0xFFFFF)).astype(np.int64)] = True
        #: of each plain term and tier, the tiered term or -1
        self.tier = np.stack([_find(self.terms, tiered(self.plain, t)) for t in TIERS], axis=1)

    def vectors(self, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(row, tiered term) of the index's terms in the rows' texts, by row, then term."""
        row, term = terms_of(rows, self.quick)
        where = _find(self.plain, term)
        hit = where >= 0
        key, n = np.unique(row[hit] * max(1, len(self.plain)) + where[hit], return_counts=True)
        row, where = key // max(1, len(self.plain)), key % max(1, len(self.plain))
        found = [(row[n >= t], self.tier[where[n >= t], i]) for i, t in enumerate(TIERS)]
        row, term = (np.concatenate(x) for x in zip(*found))
        row, term = row[term >= 0], term[term >= 0]
        order = np.lexsort((term, row))
        return row[order], term[order]

    def unit(self, term: np.ndarray) -> np.ndarray:
        w = self.idf[term]
        return w / np.sqrt((w * w).sum())

    def nearest(self, term: np.ndarray, w: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples with the k largest positive cosines (ties: earlier example)
        and the cosines.  Blocks are read in order of their bound, until no
        bound reaches the kth cosine."""
        bound = w @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        best = np.zeros(0)
        who = np.zeros(0, np.int64)
        for b in order.tolist():
            if bound[b] <= 0 or (len(best) == k and bound[b] < best[-1] - 1e-9):
                break
            cos = w @ self.weights[b, term]
            place = np.flatnonzero(cos > 0)
            cos, place = cos[place], place + b * BLOCK
            if but >= 0 and len(skip := np.flatnonzero(place == but)):
                cos, place = np.delete(cos, skip), np.delete(place, skip)
            best, who = np.append(best, np.round(cos, 9)), np.append(who, place)
            top = np.lexsort((who, -best))[:k]
            best, who = best[top], who[top]
        return who, best

    def vote(self, who: np.ndarray, cos: np.ndarray) -> float:
        weight = self.worth[who] / (1 - cos + SOFTEN)
        return float((weight * self.labels[who]).sum() / weight.sum())

    def calibrated(self, raw: float) -> float:
        i = int(np.searchsorted(self.steps, raw, "right")) - 1
        return float(self.scores[max(i, 0)])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares rising step function: starts of the steps and their values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x[order], y[order], w[order]):
        blocks.append([xi, yi * wi, wi])
        while len(blocks) > 1 and (blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2] or blocks[-2][0] == blocks[-1][0]):
            _, s, n = blocks.pop()
            blocks[-1][1] += s
            blocks[-1][2] += n
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


# ------------------------------------------------------------ learning

def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            row, term = terms_of(rows)
            order = np.argsort(row, kind="stable")
            first = np.searchsorted(row[order], np.arange(rows.num_rows + 1))
            got = [np.unique(term[order[a:b]], return_counts=True) for a, b in zip(first, first[1:])]
            yield pa.record_batch(
                [rows.column("doc_id"), rows.column("label"),
                 pa.array([u.view(np.int64) for u, _ in got], pa.list_(pa.int64())),
                 pa.array([n.astype(np.int32) for _, n in got], pa.list_(pa.int32()))], ["doc_id", "label", "terms", "counts"])


def learnable(column: str = "doc_id"):
    """Rows that labels may be learned from; the others are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(4)), F.lit(0)) != 2


@dataclass
class Sample:
    """ids (rising) and labels of the examples; of every term of each: the
    example's place, the term's hash and its count."""
    ids: np.ndarray
    labels: np.ndarray
    place: np.ndarray
    term: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Sample:
        ids = table.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        lists = table.column("terms").combine_chunks()
        return cls(ids[order], table.column("label").to_numpy()[order].astype(np.int64),
                   np.repeat(rank, pc.list_value_length(lists).to_numpy()).astype(np.int32),
                   lists.flatten().to_numpy().view(np.uint64), table.column("counts").combine_chunks().flatten().to_numpy())

    def only(self, keep: np.ndarray) -> Sample:
        return Sample(self.ids, self.labels, self.place[keep], self.term[keep], self.count[keep])


def examples(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> tuple[Sample, dict[int, int]]:
    """Terms of the sampled examples (at most ``limit`` of each label, by hash
    of the id) and the number of labelled rows of each label."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learnable())
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("example")), F.lit(1_000_000))
    keep = F.lit(False)
    for label, count in n.items():
        share = min(1_000_000, int(1_000_000 * limit / count))
        keep = keep | ((F.col("label") == label) & (place < share))
    picked = known.where(keep)
    chosen = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(picked.limit(3 * limit)), "doc_id")          # the sample: some 5,000 narrow rows
              .where("text is not null").limit(3 * limit).select("doc_id", "label", "text"))
    got = chosen.mapInArrow(_example_terms, "doc_id long, label int, terms array<long>, counts array<int>").toArrow()
    return Sample.of(got), n


def association(with1: np.ndarray, with0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Signed root of the likelihood ratio of terms that are in so many of the
    n1 and n0 examples: a z value that holds at counts of zero too, positive
    where the term speaks for label 1."""
    share = (with1 + with0) / max(1, n1 + n0)
    ratio = np.zeros(len(with1))
    for seen, expected in ((with1, n1 * share), (n1 - with1, n1 * (1 - share)), (with0, n0 * share), (n0 - with0, n0 * (1 - share))):
        ratio += seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    return np.sign(with1 * n0 - with0 * n1) * np.sqrt(2 * np.maximum(ratio, 0))


def choose_terms(sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tiered terms that speak for the label, and of the terms they come from."""
    if not len(sample.term):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    plain, where, n = np.unique(sample.term, return_inverse=True, return_counts=True)
    sample = sample.only((n >= LEAST_EXAMPLES)[where])
    plain = plain[n >= LEAST_EXAMPLES]
    del where
    label = sample.labels[sample.place]
    label, terms = (np.concatenate(x) for x in zip(*(
        (label[sample.count >= t], tiered(sample.term[sample.count >= t], t)) for t in TIERS)))
    vocabulary, where = np.unique(terms, return_inverse=True)
    with1 = np.bincount(where, weights=label == 1, minlength=len(vocabulary))
    with0 = np.bincount(where, weights=label == 0, minlength=len(vocabulary))
    n1, n0 = (sample.labels == 1).sum(), (sample.labels == 0).sum()
    z = np.where(with1 + with0 >= LEAST_EXAMPLES, association(with1, with0, n1, n0), 0.0)
    good = np.flatnonzero(z >= LEAST_Z)
    good = good[np.lexsort((vocabulary[good], -z[good]))][:TERMS]
    chosen = np.sort(vocabulary[good])
    source = np.zeros(len(plain), bool)
    for t in TIERS:
        source |= np.isin(tiered(plain, t), chosen)
    return chosen, plain[source]


def _count_terms(terms: np.ndarray, plain: np.ndarray) -> Callable:
    empty = np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Index(terms, plain, empty, empty, empty, empty, empty, empty, 0.0, empty, empty)
        df, n = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for rows in slices(batch):
                df += np.bincount(probe.vectors(rows)[1], minlength=len(terms))
                n += rows.num_rows
        used = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(df[used], n), pa.int64())], ["term", "n"])
    return run


def learn(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> Index:
    """The index of the sampled examples."""
    ship_package(docs.sparkSession)
    sample, n = examples(docs, labels, limit)
    label = sample.labels
    sampled = {x: max(1, int((label == x).sum())) for x in (0, 1)}
    worth = np.array([n.get(x, 0) / sampled[x] for x in label.tolist()], float)
    terms, plain = choose_terms(sample)
    sample = sample.only(_find(plain, sample.term) >= 0)
    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_terms(terms, plain), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())           # one row a term
    df, total = np.zeros(len(terms)), 0
    for r in rows:
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1
    return _index(sample, worth, terms, plain, idf)


def _index(sample: Sample, worth: np.ndarray, terms: np.ndarray, plain: np.ndarray, idf: np.ndarray) -> Index:
    label, vectors = sample.labels, []
    order = np.argsort(sample.place, kind="stable")
    first = np.searchsorted(sample.place[order], np.arange(len(label) + 1))
    for a, b in zip(first, first[1:]):
        t, c = sample.term[order[a:b]], sample.count[order[a:b]]
        at = np.concatenate([_find(terms, tiered(t[c >= x], x)) for x in TIERS])
        at = np.sort(at[at >= 0])
        w = idf[at]
        vectors.append((at, w / np.sqrt((w * w).sum()) if len(w) else w))
    has = np.array([len(t) > 0 for t, _ in vectors], bool)
    # examples with the same leading term share blocks, which keeps bounds tight
    lead = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
    order = [i for i in sorted(range(len(vectors)), key=lambda i: (lead[i], i)) if has[i]]
    blocks = max(1, -(-len(order) // BLOCK))
    weights = np.zeros((blocks, len(terms), BLOCK), np.float32)
    for place, i in enumerate(order):
        t, w = vectors[i]
        weights[place // BLOCK, t, place % BLOCK] = w
    rest = ~has
    base = float((label * worth).sum() / worth.sum()) if len(label) and worth.sum() else 0.0
    floor = float((label * worth)[rest].sum() / worth[rest].sum()) if rest.any() and worth[rest].sum() else base
    ids = sample.ids[order]
    index = Index(terms, plain, idf, weights, np.ascontiguousarray(weights.max(axis=2).T), ids, label[order], worth[order], floor,
                  np.zeros(1), np.full(1, floor))
    raw, truth, mass = [], [], []
    for place, i in enumerate(order):
        t, w = vectors[i]
        who, cos = index.nearest(t, w, NEIGHBOURS, but=place)
        if len(who):
            raw.append(index.vote(who, cos)), truth.append(label[i]), mass.append(worth[i])
    if raw:
        index.steps, index.scores = isotonic(np.array(raw), np.array(truth, float), np.array(mass))
    return index


# ------------------------------------------------------------ scoring

def _judge(index: Index, rows: pa.RecordBatch, seen: dict) -> tuple[np.ndarray, list[str]]:
    """Score and evidence of each row; ``seen`` remembers vectors met before."""
    score = np.full(rows.num_rows, index.floor)
    evidence = [""] * rows.num_rows
    row, term = index.vectors(rows)
    for i, a, b in zip(*_groups(row)):
        key = term[a:b].tobytes()
        if key not in seen:
            if len(seen) > 50_000:
                seen.clear()
            who, cos = index.nearest(term[a:b], index.unit(term[a:b]), NEIGHBOURS)
            seen[key] = ((index.calibrated(index.vote(who, cos)), " ".join(
                f"{index.ids[x]}:{index.labels[x]}:{c:.3f}" for x, c in zip(who[:3], cos[:3]))) if len(who) else (index.floor, ""))
        score[i], evidence[i] = seen[key]
    return score, evidence


def _score(broadcast, kept: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            for rows in slices(batch):
                score, evidence = _judge(broadcast.value, rows, seen)
                yield pa.record_batch([rows.column(c) for c in kept] + [pa.array(score), pa.array(evidence, pa.string())],
                                      kept + ["score", "evidence"])
    return run


def _groups(row: np.ndarray) -> tuple[list, list, list]:
    at = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    return row[at].tolist(), at.tolist(), np.append(at[1:], len(row)).tolist()


def score(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, evidence
    (id:label:cosine of the nearest examples).

    Null or empty text, or one without a known term, gets the share of toxic
    documents among examples without known terms.  Null ids are not held out
    and never learned from; repeated rows are scored alike.  Without labelled
    rows every score is 0.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(learn(docs, labels, limit))       # bounded by EXAMPLES and TERMS: some 40 MB at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~learnable()).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_score(index, ["doc_id", "held_out"]), "doc_id long, held_out boolean, score double, evidence string")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def keep_clean(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, same columns."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(learn(docs, labels, limit))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            for rows in slices(batch):
                yield rows.filter(pa.array(_judge(index.value, rows, seen)[0] < THRESHOLD))
    return docs.mapInArrow(run, schema)
