"""Exact dense kNN (R1, dense form): inner product of unit vectors = cosine.

Spark has no vector-similarity operator, so the scoring is a block matrix
product in NumPy inside ``mapInArrow``; everything around it (partitioning,
exchange, the final top-k) is ordinary Spark.

Queries are scored in tiles of a bounded number of rows.  A single tile is
broadcast and the documents are scanned, never shuffled; several tiles travel
in strips that meet blocks of documents by number (``tiles.meet``), so the
driver never holds more than one tile, the plan is the same for any number of
them and small tiles cost no more exchange than large ones.  Each task
keeps exactly k rows per query.  Scoring every vector against every other is quadratic by nature: the
plan keeps it distributed and memory-bounded, not cheap.

Vectors take part when they are not null, have the common length, and hold
no null or non-finite component; all others are listed by ``vector_rejects``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.operators import tiles
from citegrid.operators.topk import BestSoFar, top_k
from citegrid.session import materialize, ship_package

#: Query rows of one tile; a tile of 768 floats is 24 MB in a task.
TILE_ROWS = 4096
#: Query rows multiplied at a time, at most.
CHUNK = 512


def dimension(vectors: DataFrame, vec: str) -> int:
    """The length that most vectors have (the smaller one of two as frequent)."""
    row = (vectors.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("d")).count()
           .orderBy(F.desc("count"), "d").first())
    return int(row["d"]) if row else 0


def usable(vec: str, dim: int) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == dim) & fine, F.lit(False))


def vector_rejects(vectors: DataFrame, key: str, vec: str, dim: int) -> DataFrame:
    """``(key, reason)`` of the rows that take no part in dense retrieval."""
    reason = (F.when(F.col(vec).isNull(), "null vector").when(F.size(vec) != dim, "other length")
              .otherwise("null or non-finite component"))
    return vectors.where(~usable(vec, dim)).select(key, reason.alias("reason"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """A list<float> Arrow column of equal-length vectors as an (n, d) matrix."""
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _best(qids: np.ndarray, Q: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray]], k: int, exclude_self: bool,
          schema: pa.Schema, chunk: int = CHUNK) -> pa.RecordBatch:
    """The k best documents of all blocks (ids, vectors) for each query."""
    tiles_best = [BestSoFar(k) for _ in range(0, len(qids), chunk)]
    for ids, D in blocks:
        for best, lo in zip(tiles_best, range(0, len(qids), chunk)):
            S = Q[lo:lo + chunk] @ D.T
            if exclude_self:
                S[qids[lo:lo + chunk, None] == ids[None, :]] = -np.inf
            best.add(S, ids)
    q = np.concatenate([best.q + i * chunk for i, best in enumerate(tiles_best)] or [np.zeros(0, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(qids[q].tolist(), schema.field(0).type),
                                       pa.array([d for best in tiles_best for d in best.ids()], schema.field(1).type),
                                       pa.array(np.concatenate([best.s for best in tiles_best] or [np.zeros(0)]))], schema=schema)


def _vectors(rows: pa.Table | pa.RecordBatch, key: str, vec: str) -> tuple[np.ndarray, np.ndarray]:
    ids, lists = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (rows.column(key), rows.column(vec)))
    return ids.to_numpy(zero_copy_only=False), _matrix(lists)


def _score_tile(tile, k: int, did: str, dvec: str, schema: pa.Schema, exclude_self: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _best(*tile.value, (_vectors(rb, did, dvec) for rb in batches if rb.num_rows), k, exclude_self, schema)
    return run


def knn_candidates(queries: DataFrame, docs: DataFrame, k: int, qid: str = "qid", qvec: str = "vector",
                   did: str = "pmid", dvec: str = "vector", exclude_self: bool = False,
                   tile_rows: int = TILE_ROWS) -> DataFrame:
    """Candidates ``(qid, did, score)``: at least the k best of each query."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = queries.sparkSession
    ship_package(spark)
    schema = spark.createDataFrame([], f"{qid} {dict(queries.dtypes)[qid]}, {did} {dict(docs.dtypes)[did]}, score double").schema
    arrow = to_arrow_schema(schema)
    dim = dimension(docs, dvec)
    asked = queries.select(qid, qvec).where(usable(qvec, dim))
    asked = materialize(asked, "query-tiles")
    n_asked = asked.count()
    found = docs.select(did, dvec).where(usable(dvec, dim))
    if n_asked <= tile_rows:
        tile = _vectors(asked.toArrow(), qid, qvec)                                         # at most tile_rows rows
        return found.mapInArrow(_score_tile(spark.sparkContext.broadcast(tile), k, did, dvec, arrow, exclude_self), schema)
    rows_at_once = tiles.BLOCK_ROWS

    def score(strip: pa.Table, block: pa.Table) -> pa.Table:
        ids, D = _vectors(block, did, dvec)
        parts = ((ids[lo:lo + rows_at_once], D[lo:lo + rows_at_once]) for lo in range(0, len(ids), rows_at_once))
        return pa.Table.from_batches([_best(*_vectors(strip, qid, qvec), parts, k, exclude_self, arrow, min(CHUNK, tile_rows))])
    return tiles.meet(asked, n_asked * max(dim, 1), qid, found, docs.count() * max(dim, 1), did, score, schema,
                      lambda cand: top_k(cand, k, group=qid, item=did).drop("rank"))


def knn(queries: DataFrame, docs: DataFrame, k: int, qid: str = "qid", qvec: str = "vector",
        did: str = "pmid", dvec: str = "vector", **kw) -> DataFrame:
    """R1 + R2 + R3: ``(qid, did, score, rank)``, k per query."""
    cand = knn_candidates(queries, docs, k, qid, qvec, did, dvec, **kw)
    return top_k(cand, k, group=qid, item=did)
